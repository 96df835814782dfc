"""License scans by ordered signature rules.

* keyword prefilter: a word that is no signature's first word costs one look-up
  in the set of keywords; only at keywords is a window of words cut, and only
  the rules of that keyword are tried on it (``license_rules``);
* priority and containment: a finding goes if another finding's words hold
  its own, are more and are of no lower priority, or are the same and the
  other rule stands above. A signature has fewer than ``WINDOW`` words, so
  only findings that begin at most so far before can hold another.

One projection per document: no shuffle and no Python. The rules are
literals of the plan, their number does not grow with the input.

Defined results: NULL and empty texts have no words and no findings (score 0,
empty labels); a NULL doc_id stays NULL; repeated rows are rows of their
own; an empty table gives no rows. Columns besides doc_id and text are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_rules import BASE, KEYWORDS, RULES
from .shared import documents

WINDOW = 24  #: words of a window; no signature has more
WORD = "[^\\\\x00-\\\\x2F\\\\x3A-\\\\x60\\\\x7B-\\\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _tried() -> str:
    """Findings at hit ``h``: the rules of its keyword on its window."""
    arms = []
    for word, rules in KEYWORDS.items():
        found = ", ".join(f"struct({r.number} AS rule, h.at AS at, size(split(regexp_extract(h.near, {_q(r.pattern)}, 0), ' ')) - 1 "
                          "AS n)" for r in rules)
        arms.append(f"WHEN {_q(word)} THEN array({found})")
    return f"CASE h.word {' '.join(arms)} END"


def license_scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words and findings (label, weight, first word, words, base phrase?, kept?) by first word."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    # lower() is for ASCII texts alone: elsewhere it changes more than A-Z
    low = F.expr(f"CASE WHEN octet_length(_t) = length(_t) THEN lower(_t) ELSE translate(_t, '{UPPER}', '{LOWER}') END")
    words = own.select("doc_id", F.regexp_extract_all(low, F.expr(f"'{WORD}'"), F.lit(0)).alias("_w"))
    keys = ", ".join(map(_q, KEYWORDS))
    # _w stands in the array and in the lambda: Spark keeps it as a column of its own
    hits = words.select("doc_id", F.size("_w").cast("long").alias("n_words"), F.expr(
        f"filter(transform(_w, (w, i) -> IF(w IN ({keys}), struct(i AS at, w AS word, concat(array_join("
        f"slice(_w, i + 1, {WINDOW}), ' '), ' ') AS near), NULL)), h -> h IS NOT NULL)").alias("_h"))
    # findings by hit: at most WINDOW hits begin within a window, so few others can hold a finding
    found = hits.select("doc_id", "n_words", F.expr(
        f"filter(transform(_h, h -> filter({_tried()}, f -> f.n > 0)), g -> size(g) > 0)").alias("_f"))
    labels = ", ".join(_q(r.label) for r in RULES)
    weights = ", ".join(f"{r.weight}D" for r in RULES)
    ranks = ", ".join(str(r.priority) for r in RULES)
    held = (f"exists(slice(_f, greatest(j + 2 - {WINDOW}, 1), {WINDOW}), x -> exists(x, e -> e.at <= f.at AND e.at + e.n >= f.at + f.n "
            f"AND ((e.n > f.n AND element_at(array({ranks}), e.rule) <= element_at(array({ranks}), f.rule)) "
            "OR (e.n = f.n AND e.rule < f.rule))))")
    return found.select("doc_id", "n_words", F.expr(
        f"flatten(transform(_f, (g, j) -> transform(g, f -> struct(element_at(array({labels}), f.rule) AS label, "
        f"element_at(array({weights}), f.rule) AS weight, CAST(f.at AS BIGINT) AS at, CAST(f.n AS BIGINT) AS n, "
        f"f.rule <= {BASE} AS base, NOT {held} AS kept))))").alias("findings"))


def digests(scanned: DataFrame) -> DataFrame:
    """The columns of ``op12`` from ``license_scan``."""
    base = scanned.select("*", F.expr("filter(findings, f -> f.base)").alias("_b"),
                          F.expr("filter(findings, f -> f.kept)").alias("_k"))
    return base.select(
        "doc_id", "n_words", F.size("_b").cast("long").alias("n_base"),
        F.expr("array_min(transform(_b, f -> f.at))").alias("first_word"),
        F.expr("array_max(transform(_b, f -> f.at))").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(transform(_b, f -> f.label))), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_distinct(concat(transform(_b, f -> f.label), transform(_k, f -> f.label)))), ',')")
        .alias("labels"),
        F.expr("coalesce(array_max(transform(_k, f -> f.weight)), 0D)").alias("score"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License findings of every whole text: n_words, base places, labels, score."""
    return digests(license_scan(documents(spark, sf_dir)))


def oracle_sql() -> str:
    """DuckDB: words numbered as rows, rules joined on the keyword, containment as an anti-join; base phrases apart."""
    rules = ",\n".join("({}, '{}', {}, {}e0, '{}', '{}')".format(r.number, r.label, r.priority, r.weight, w, r.pattern)
                       for r in RULES for w in r.keywords)
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    base = " UNION ALL ".join(
        "SELECT id, '{}' AS label, i - 1 AS pos FROM p WHERE {}".format(
            label, " AND ".join(f"words[i + {k}] = '{w}'" if k else f"words[i] = '{w}'" for k, w in enumerate(phrase.split())))
        for phrase, label in phrases.items())
    return f"""WITH rules(rule, label, rank, weight, word, pattern) AS (VALUES {rules}),
w AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
p AS (SELECT id, words, unnest(range(1, len(words) + 1)) AS i FROM w),
b AS ({base}),
f AS (SELECT id, rule, label, rank, weight, i - 1 AS pos, len(string_split(m, ' ')) - 1 AS n FROM (
  SELECT p.id, p.i, r.*, regexp_extract(array_to_string(words[i : i + {WINDOW - 1}], ' ') || ' ', pattern) AS m
  FROM p JOIN rules r ON r.word = p.words[p.i]) WHERE m <> ''),
k AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM f e WHERE e.id = f.id AND e.pos <= f.pos AND e.pos + e.n >= f.pos + f.n
  AND ((e.n > f.n AND e.rank <= f.rank) OR (e.n = f.n AND e.rule < f.rule)))),
bs AS (SELECT id, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b GROUP BY id),
ls AS (SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
  SELECT id, label FROM b UNION ALL SELECT id, label FROM k) GROUP BY id),
ss AS (SELECT id, max(weight) AS score FROM k GROUP BY id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(bs.n, 0) AS n_base, CAST(bs.first_word AS BIGINT) AS first_word,
  CAST(bs.last_word AS BIGINT) AS last_word, coalesce(bs.labels, '') AS base_labels, coalesce(ls.labels, '') AS labels,
  coalesce(ss.score, 0e0) AS score
FROM w LEFT JOIN bs USING (id) LEFT JOIN ls USING (id) LEFT JOIN ss USING (id)"""
