"""Periodic runs, license scan and tokenizer alignment against brute force and the libraries; odd rows of every kind."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_llm import DOCS, SF, odd_rows
from tokenizers import Tokenizer

from millstat.llm import license_rules, license_scan, periodic_runs, token_align


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ----------------------------------------------------------------- periodic runs

def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, x in enumerate(same):
            if x and start is None:
                start = i
            elif not x and start is not None:
                if i - start + q >= max(6, 4 * q):
                    found.setdefault((start, i + q), q)
                start = None
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    rest = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), hashlib.sha256(rest).hexdigest())


def random_words(rng):
    out = []
    for _ in range(rng.randint(0, 6)):
        block = [f"w{rng.randrange(rng.choice([1, 2, 3, 9, 60]))}" for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 21, 40]))]
        times = rng.randint(1, 9)
        out += (block * times)[: len(block) * times - rng.randrange(len(block))]
        if out and rng.random() < 0.3:
            out += out[rng.randrange(len(out)):]
    return out


def test_runs_equal_brute_force(spark, odd, empty):
    rng = random.Random(7)
    thue = ["a"]
    while len(thue) < 512:
        thue += [{"a": "b", "b": "a"}[c] for c in thue]
    special = [thue, ["x"] * 700, (["a"] * 40 + ["b"]) * 12, ((["a"] * 20 + ["b"]) * 6 + ["c"]) * 5, ["p", "q", "p"] * 90]
    rows = [(i, "  ".join(w), "l", "s", 0, 0.0, "x") for i, w in enumerate([random_words(rng) for _ in range(160)] + special)]
    rows += [r for r in odd_rows() if not r[1] or len(r[1]) < 30_000]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.repeating(docs))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute_row(r[0], r[1]) for r in rows), key=repr)
    assert sum(r["n_runs"] for r in got) > 200
    assert periodic_runs.periodic_runs(empty).count() == 0


def test_a_long_run_of_one_word(odd):
    r = periodic_runs.periodic_runs(odd).where("n_words = 30000").first()
    assert [tuple(x) for x in r["runs"]] == [(0, 30_000, 1)] and r["collapsed"] == "long"


def test_runs_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(20)], "doc_id long, text string").coalesce(1)
    assert {len(r["runs"]) for r in periodic_runs.periodic_runs(docs).collect()} == {0}


# ----------------------------------------------------------------- license scan

def test_rules_fit_their_window():
    assert len(license_rules.RULES) > 250
    assert [(r.label, r.keywords) for r in license_rules.RULES[:license_rules.BASE]] == [
        ("gpl", ("gnu",)), ("apache", ("apache",)), ("cc-by", ("cc",)), ("mit", ("mit",))]
    assert max(r.pattern.count(" ") for r in license_rules.RULES) < 2 * license_scan.WINDOW
    assert {r.priority for r in license_rules.RULES} == {1, 2, 3} and all(0 < r.weight <= 1 for r in license_rules.RULES)


def test_license_cases(spark, odd, empty):
    cases = {
        "GNU General Public License, version 2 or later": (8, 1, 0, 0, "gpl", "gpl,gpl-2.0"),
        "x Apache License 2.0; MIT\nlicense": (7, 2, 1, 5, "apache,mit", "apache,apache-2.0,mit"),
        "CC-BY-SA 4.0 and cc by cc BY": (10, 3, 0, 8, "cc-by", "cc-by,cc-by-sa-4.0"),
        "the lesser general public licenses of a gnu": (8, 0, None, None, "", ""),
        "SPDX-License-Identifier: BSD-3-Clause": (6, 0, None, None, "", "bsd-3-clause,spdx-tag"),
        "gnu lesser general public license v2.1": (7, 0, None, None, "", "lgpl-2.1"),
        "\u00c9apache license mit\u00a0license m\u0131t license": (5, 0, None, None, "", ""),
        None: (0, 0, None, None, "", ""), "": (0, 0, None, None, "", ""), "K MIT LICENSE": (3, 1, 1, 1, "mit", "mit"),
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = license_scan.digests(license_scan.license_scan(docs)).orderBy("doc_id").collect()
    assert [tuple(r)[1:7] for r in got] == list(cases.values())
    assert all((r["score"] > 0) == (r["labels"] != "") and r["score"] <= 1 for r in got)
    assert license_scan.license_scan(odd).count() == odd.count() and license_scan.license_scan(empty).count() == 0


def test_an_identifier_holds_the_names_inside_it(spark):
    docs = spark.createDataFrame([(1, "licensed under the Apache License, Version 2.0")], "doc_id long, text string")
    found = license_scan.license_scan(docs).first()["findings"]
    assert [(f["label"], f["at"], f["n"]) for f in found if f["kept"]] == [("apache-2.0", 0, 8)]
    assert [(f["label"], f["at"]) for f in found if f["base"]] == [("apache", 3)]


def test_license_scan_is_native_and_linear(spark):
    docs = spark.createDataFrame([(1, "MIT License, CC-BY 4.0 and words " * 20_000)], "doc_id long, text string")
    scan = license_scan.license_scan(docs)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert scan.select(F.size("findings")).first()[0] >= 60_000


# ----------------------------------------------------------------- alignment

class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in letters]
        self.byte = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(rest)}

    def tokens(self, text):
        a = [(i, len(bytes(self.byte[c] for c in self.a.id_to_token(i)))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        names = [(i, self.b.id_to_piece(i)) for i in self.b.encode(text)]
        joined = b"".join(bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in names)
        if joined != (" " + text).encode():
            return [], []
        return a, [(i, 1 if self.b.is_byte(i) else len(p.replace("▁", " ").encode())) for i, p in names]

    def align(self, text):
        """(ids of A, ids of B) of each group."""
        a, b = self.tokens(text) if text else ([], [])
        groups, x, y, now = [], 0, 0, ([], [])
        while a or b:
            side = 0 if x <= y else 1
            i, n = (a, b)[side].pop(0)
            now[side].append(i)
            x, y = (x + n, y) if side == 0 else (x, y + n)
            if x == y:
                groups.append(now)
                now = ([], [])
        return groups


def test_alignment_equals_brute_force(spark, empty):
    texts = [r[1] for r in odd_rows() if not r[1] or len(r[1]) < 30_000]
    texts += [" lead", "trail  ", "a   b", "tab\tx\n\n y \t z", "<s> </s> <unk> <0x41> <|endoftext|>", "a▁b", "\x00 nul",
              "😀😀 naïve 日本語", "x" * 300 + " y", "don't we'll 12345 3.14", "　 wide", "  \n \t a"]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 4000").limit(60).collect()]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, groups string").repartition(3)
    own = Brute()
    groups = [own.align(t) for t in texts]
    count: dict = {}
    for g in groups:
        for a, b in g:
            count[a[-1], b[-1]] = count.get((a[-1], b[-1]), 0) + 1
    best: dict = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    want = []
    for i, g in enumerate(groups):
        links = [(a[-1], b[-1]) for a, b in g]
        digest = sha(";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)) if g else ""
        want.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                     sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), digest))
    assert [tuple(r) for r in token_align.digests(spark, docs).orderBy("doc_id").collect()] == want
    assert sum(w[4] for w in want) > 1000
    assert token_align.digests(spark, empty).count() == 0


def test_repeated_rows_and_null_ids_keep_their_rows(spark, odd):
    got = token_align.digests(spark, odd)
    assert got.count() == odd.count() and got.where("doc_id IS NULL").count() == 1


def test_possible_pairs_bound_the_counts():
    assert token_align.possible_pairs() < 400_000


def test_short_memory_changes_nothing(spark, monkeypatch):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect()]
    whole = token_align.Aligner()
    want = whole.texts(texts)
    monkeypatch.setattr(token_align, "KEPT", 50)
    forgetful = token_align.Aligner()
    assert [forgetful.texts([t])[0] for t in texts] == want


def test_one_part_that_its_tokens_do_not_spell(monkeypatch):
    """A vocabulary that loses a letter: texts with it have no tokens, the others keep theirs."""
    own = token_align.Aligner()
    want = own.texts(["one two", "three four"])
    lossy = token_align.Aligner()
    ids = lossy.b.ids
    monkeypatch.setattr(lossy.b, "ids", lambda parts: [i[:-1] if "q" in p else i for p, i in zip(parts, ids(parts))])
    assert lossy.texts(["one two", "a quiet one", "three four"]) == [want[0], (0, 0, "", b""), want[1]]


# ----------------------------------------------------------------- labelled samples

def test_samples_draw_on_labels_and_move_no_text(spark):
    from millstat.llm import quality, shared, toxicity

    docs, marks = shared.documents(spark, SF), shared.labels(spark, SF)
    for own, held, modulus in ((toxicity, 0, 5), (quality, 2, 4)):
        y = own.marked(marks)
        rows, taken = toxicity.labelled(docs, y, 20)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        ids = [r["doc_id"] for r in rows.collect()]
        assert 0 < len(ids) < y.count() and all(0 < t <= 1 for t in taken)
        assert all(zlib.crc32(str(i).encode()) % modulus != held for i in ids)
        everything, shares = toxicity.labelled(docs, y, 10 ** 6)
        assert shares == (1.0, 1.0) and everything.count() == y.join(docs, "doc_id").count()
