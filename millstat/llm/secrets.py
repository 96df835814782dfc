"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are values assigned to a secret-like name and runs of key characters
with a digit. Their features are length, character classes and the
transitions between them, how much of them dictionary words cover, their
path and the words before and after. A random forest (pyspark.ml), trained on
labelled findings, votes; its trees become column expressions, so a scan is one
projection over the documents: no Python, no join, no shuffle.

The tables have no labelled findings, so ``labelled_findings`` derives them by rule
(key formats in assignments against hashes of files, identifiers, numbers,
placeholders); ``train`` takes any table of that shape.

Defined results: NULL and empty texts have no candidates; a NULL path is
empty; repeated rows have their own findings; ``start`` counts characters
from 0; a text without findings gives no rows in ``findings``.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, numbered, stored

LABELLED_ROWS = 6000
TREES, DEPTH, SEED = 15, 6, 5
SECRET = 0.5
MASK = "[SECRET]"
_NAME = r"(?i:password|passwd|pwd|secret|token|api_?key|access_?key|private_?key|auth|credential)"
_ASSIGN = _NAME + r"[\"']?\s?[:=]\s?[\"']?"
CANDIDATE = (rf"{_ASSIGN}[^\s\"'<>,;]{{6,}}"
             r"|(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{8,}={0,2}")

#: fixed values: words that cover parts of identifiers, paths and placeholders
DICTIONARY = ("password secret token key user name test example sample demo dummy change your here value default none null true "
              "false file path data main src lib bin usr home index page http https www com org html image version release "
              "build commit branch master config local host server client admin root public private access auth login "
              "session cookie order item number date time year month day report section chapter figure table code error "
              "line text word list map set get put post").split()
#: fixed values: words before a value that name something else than a secret
OTHER_NAMES = r"(?i)\b(commit|checksum|md5|sha1|sha256|digest|hash|uuid|guid|id|version|build|order|phone|tel|card|number|ref)\W{0,4}$"

FEATURES = ["length", "digits", "upper", "lower", "marks", "changes", "variety", "covered", "hex", "placeholder", "dashes",
            "test_path", "doc_path", "slashes", "named", "assigned", "quoted", "other_name", "url_before", "closed"]


def _share(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))


def features(value: Column, before: Column, after: Column, path: Column) -> list[Column]:
    """The columns of FEATURES, as doubles."""
    n = F.greatest(F.length(value), F.lit(1))
    low = F.lower(value)
    words = "|".join(sorted(DICTIONARY, key=len, reverse=True))
    # marks the end of each run of one class, so the transitions can be counted
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        value, "[0-9]+", "\u0001"), "[A-Z]+", "\u0002"), "[a-z]+", "\u0003"), "[^\u0001-\u0003]+", "\u0004")
    has = lambda text, pattern: text.rlike(pattern)
    columns = [
        F.least(n, F.lit(200)), _share(value, "[^0-9]"), _share(value, "[^A-Z]"), _share(value, "[^a-z]"),
        _share(value, "[A-Za-z0-9]"), (F.length(classes) - 1) / n,
        F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(40)), 1 - F.length(F.regexp_replace(low, words, "")) / n,
        has(value, "^[0-9a-fA-F]+$"), has(low, r"(x{4,}|\*{3,}|\.{3,}|1234|abcd|0000|change|example|dummy|sample|your|placeholder|\$\{|%[a-z])"),
        has(value, "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"),
        has(path, r"(?i)(test|spec|mock|fixture)"), has(path, r"(?i)(doc|readme|example|sample)"),
        F.length(F.regexp_replace(value, "[^/_]", "")),
        has(before, _NAME[:4] + _NAME[4:-1] + r")\W{0,6}$"), has(before, r"[:=]\s?[\"']?$"), has(before, r"[\"']$"),
        has(before, OTHER_NAMES), has(before, r"(?i)(https?://|www\.)\S*$"), has(after, r"^[\"']"),
    ]
    return [c.cast("double").alias(name) for c, name in zip(columns, FEATURES)]


def labelled_findings(spark: SparkSession, rows: int = LABELLED_ROWS) -> DataFrame:
    """(value, before, after, path, label): findings with their verdicts, a fixed function of ``rows``."""
    ids = spark.range(0, rows, 1, 1)
    text = lambda salt: F.concat(F.lit(salt), F.col("id").cast("string"))
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    pick = lambda salt, options: F.element_at(F.array(*map(F.lit, options)), draw(salt, len(options)) + 1)
    hexes = F.concat(F.sha1(text("a").cast("binary")), F.sha1(text("b").cast("binary")))
    base = F.regexp_replace(F.base64(F.unhex(F.sha2(text("c").cast("binary"), 512))), "[+/=\r\n]", "k")
    short = draw("n", 29) + 12
    name = pick("name", ["password=", "password = \"", "token = \"", "token: ", "secret = '", "api_key=", "API_KEY: \"", "auth_token=\"",
                         "passwd=", "access_key = \""])
    prose = pick("prose", ["of the ", "see ", "and then ", "the. ", "a ", "we, ", "for ", "mit der ", "dans le ", "de la ", "und ", "| "])
    word = pick("word", DICTIONARY)
    # a chosen password: letters that are no dictionary word
    made = F.substr(F.lower(F.regexp_replace(base, "[^A-Za-z]", "")), F.lit(1), draw("m", 5) + 4)
    kinds = [  # value, before, label
        (F.substring(hexes, 1, 40), name, 1), (F.substr(hexes, F.lit(1), short), name, 1),
        (F.substr(base, F.lit(1), short + 8), name, 1), (F.concat(F.lit("AKIA"), F.upper(F.substring(base, 1, 16))), F.when(draw("p", 2) == 0, name).otherwise(prose), 1),
        (F.concat(pick("pre", ["ghp_", "sk_live_", "xoxb-", "glpat-"]), F.substring(base, 1, 36)), F.when(draw("p", 2) == 0, name).otherwise(prose), 1),
        (F.substring(base, 1, 40), name, 1),
        (F.concat(made, draw("d", 99).cast("string"), made), name, 1), (F.concat(made, draw("d", 99).cast("string"), F.lower(made), F.lit("7")), name, 1),
        (F.substring(hexes, 1, 40), pick("o", ["commit ", "sha1 ", "checksum: ", "hash ", "digest=", "md5: "]), 0),
        (F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4), F.substring(hexes, 17, 4), F.substring(hexes, 21, 12)),
         F.when(draw("p", 2) == 0, F.lit("id: ")).otherwise(prose), 0),
        (F.substr(F.regexp_replace(hexes, "[a-f]", "7"), F.lit(1), draw("d", 10) + 8), prose, 0),
        (F.concat_ws("_", word, pick("w2", DICTIONARY), draw("d", 99).cast("string")), prose, 0),
        (F.concat_ws("/", word, pick("w2", DICTIONARY), F.concat(pick("w3", DICTIONARY), draw("d", 9).cast("string"))), prose, 0),
        (F.concat(pick("ph", ["changeme", "your_token_", "xxxxxxxx", "example", "dummy_secret", "password", "placeholder"]), draw("d", 9).cast("string")), name, 0),
        (F.concat_ws("-", F.lit("555"), draw("d", 900).cast("string"), draw("e", 9000).cast("string")), pick("o", ["phone ", "tel: ", "call ", "+1 "]), 0),
        (F.concat(word, draw("d", 2030).cast("string")), prose, 0), (word, name, 0),
    ]
    kind = F.pmod(F.col("id"), F.lit(len(kinds)))
    choose = lambda k: F.coalesce(*[F.when(kind == i, r[k] if isinstance(r[k], Column) else F.lit(r[k])) for i, r in enumerate(kinds)])
    path = pick("path", ["src0", "src7", "app/settings.py", "tests/test_login.py", "docs/readme.md", "lib/client.js", "web", ""])
    return ids.select(choose(0).alias("value"), choose(1).alias("before"),
                      F.when(choose(1).rlike("[\"']$"), F.lit("\" ")).otherwise(F.lit(" ")).alias("after"), path.alias("path"),
                      choose(2).alias("label"))


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> list[str]:
    """Random forest on labelled findings: each tree's rules as text.

    ``labelled`` is a bounded table (``LABELLED_ROWS`` here). Its rows are one partition, as
    the trees' samples are drawn per partition: equal rows give equal trees on any number of cores.
    """
    rows = labelled.select(*features(*[F.coalesce(F.col(c), F.lit("")) for c in ("value", "before", "after", "path")]),
                           F.col("label").cast("double").alias("label"))
    rows = stored(rows.coalesce(1), "secret-labels").coalesce(1)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(assembled)
    return [tree.toDebugString for tree in model.trees]


_RULE = re.compile(r"(If|Else) \(feature (\d+) (<=|>) ([-0-9.E]+)\)|Predict: ([-0-9.]+)")


def vote(rules: str, of: Column) -> Column:
    """One tree's rules as a column expression over a struct of FEATURES."""
    steps = [m.groups() for m in _RULE.finditer(rules)]
    at = 0

    def node() -> Column:
        nonlocal at
        kind, feature, _, bound, predicted = steps[at]
        at += 1
        if predicted is not None:
            return F.lit(float(predicted))
        low = node()
        at += 1  # the matching Else
        return F.when(of[FEATURES[int(feature)]] <= float(bound), low).otherwise(node())

    return node()


def _running(sizes: Column) -> Column:
    """Running sums of an array: each step adds the sum that ends 1, 2, 4, ... places before."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(sizes), F.lit(1)))).cast("int"))

    def add(sums: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(sums, lambda x, i: x + F.when(i >= back, F.get(sums, i - back)).otherwise(0))

    return F.aggregate(steps, sizes, add)


def scan(docs: DataFrame, trees: list[str], text: str = "text", path: str = "source") -> DataFrame:
    """Adds ``findings``: array of (start, length, value, score) of every candidate of the whole text.

    Each step is a ``transform`` over the array of the step before, and its function reads
    nothing but its own element: the work grows with the candidates of a text, not with their square.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    place = F.coalesce(F.col(path).cast("string"), F.lit(""))
    found = docs.withColumn("_hits", F.when(body.rlike(CANDIDATE), F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0))))
    found = found.withColumn("_gaps", F.when(F.col("_hits").isNotNull(), F.split(body, CANDIDATE, -1)))
    hits = F.size("_hits")
    sizes = F.zip_with(F.slice("_gaps", F.lit(1), hits), "_hits", lambda g, h: F.length(g) + F.length(h))
    parts = F.arrays_zip(F.col("_hits").alias("hit"), F.slice("_gaps", F.lit(1), hits).alias("gap"),
                         F.slice("_gaps", F.lit(2), hits).alias("next"), _running(sizes).alias("end"))

    def cut(x: Column) -> Column:
        return F.struct(F.regexp_replace(x["hit"], "^" + _ASSIGN, "").alias("value"), x["hit"].alias("hit"),
                        F.right(x["gap"], F.lit(60)).alias("gap"), F.left(x["next"], F.lit(20)).alias("after"), x["end"].alias("end"))

    def describe(x: Column) -> Column:
        before = F.concat(x["gap"], F.substr(x["hit"], F.lit(1), F.length(x["hit"]) - F.length(x["value"])))
        return F.struct((x["end"] - F.length(x["value"])).alias("start"), F.length(x["value"]).alias("length"), x["value"].alias("value"),
                        F.struct(*features(x["value"], before, x["after"], place)).alias("f"))

    def judge(x: Column) -> Column:
        votes = [vote(rules, x["f"]) for rules in trees]
        total = votes[0]
        for v in votes[1:]:
            total = total + v
        return F.struct(x["start"].alias("start"), x["length"].alias("length"), x["value"].alias("value"),
                        (total / len(votes)).alias("score"))

    judged = F.transform(F.transform(F.transform(parts, cut), describe), judge)
    return found.withColumn("findings", F.when(F.col("_hits").isNotNull(), judged)).drop("_hits", "_gaps")


def findings(docs: DataFrame, trees: list[str]) -> DataFrame:
    """(doc_id, start, length, value, score, is_secret): a row per candidate."""
    path = F.col("source") if "source" in docs.columns else F.lit("")
    return (scan(docs.select("doc_id", "text", path.alias("source")), trees).select("doc_id", F.explode("findings").alias("x"))
            .select("doc_id", "x.start", "x.length", "x.value", "x.score", (F.col("x.score") >= SECRET).alias("is_secret")))


def redact(docs: DataFrame, trees: list[str], mask: str = MASK) -> DataFrame:
    """``docs`` with every value judged secret replaced wherever it occurs in its text."""
    text = f"c{docs.columns.index('text')}"
    own = numbered(docs).withColumn("path", F.col(f"c{docs.columns.index('source')}") if "source" in docs.columns else F.lit(""))
    scanned = scan(own, trees, text, "path")
    secret = F.array_distinct(F.transform(F.filter("findings", lambda x: x["score"] >= SECRET), lambda x: x["value"]))
    clean = F.aggregate(F.sort_array(F.coalesce(secret, F.array().cast("array<string>")), asc=False), F.col(text).cast("string"),
                        lambda t, s: F.replace(t, s, F.lit(mask)))
    return scanned.withColumn(text, clean).select(*own.columns[:-1]).toDF(*docs.columns)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of all documents with the forest's verdict; values as digests."""
    found = findings(documents(spark, sf_dir), train(labelled_findings(spark)))
    return found.select("doc_id", "start", "length", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score",
                        "is_secret")
