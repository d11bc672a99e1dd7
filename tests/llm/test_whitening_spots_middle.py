"""Whitening, spot signatures and fill-in-middle against plain versions."""

import bisect
import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from beaconfold.llm import fill_in_middle, spot_signatures, succession, whitening

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, row string, part string, last string, key string, parts string, times string"


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, markers, and columns whose names operators use."""
    prose = "The river was the way to a bridge that is there, and of the mills nobody said much. "
    texts = [
        None, "", " \n\t ", "one", "<P>", "a <S> b", "x<", "<S", "é 　日本語 text the ÉTÉ de la mer", "the", prose * 3, prose * 3, prose * 2 + "Other ends.",
        "".join(f"{prose}{i} word{i} " for i in range(4000)), "z" * 70_000 + "1 the end of it", "\r\n\x00a1b2", "Der Tag ist das Ende von dem Weg.",
    ]
    rows = [(i * 7 % 17, t, *"rplkqt") for i, t in enumerate(texts)]
    rows += [rows[10]] * 3 + [(rows[10][0], "another text of the same id is there", *"rplkqt"), (None, "nobody's the text", *"rplkqt"), (None, None, *"rplkqt")] + [rows[0]]
    return spark.createDataFrame(rows, DOCS).repartition(5)


# ---- whitening ------------------------------------------------------------------------------


def plain_whitening(rows, components=16):
    """rows: (id, list) -> id -> rows of (deviation, whitened, explained); for vectors of one length."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for i, v in good}
    fit = sorted(set(x.values()))
    n, dims = len(fit), len(fit[0])
    sums = [sum(f[d] for f in fit) for d in range(dims)]
    centred = np.array([[n * f[d] - sums[d] for d in range(dims)] for f in fit], np.float64) / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, own in x.items():
        gap = [n * own[d] - sums[d] for d in range(dims)]
        out[i] = (sum(g * g for g in gap), np.array(gap) / n @ vectors / np.sqrt(values), values / np.trace(v), n)
    return out


def test_whitening_query(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet'").fetchall()
    want = plain_whitening(rows)
    got = {}
    for r in whitening.op11_whitening(spark, SMALL).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert got.keys() == want.keys()
    signs = None
    for i, (deviation, white, explained, n) in want.items():
        mine = [got[i][k] for k in range(1, 17)]
        if signs is None:
            signs = np.sign([m.whitened / w for m, w in zip(mine, white, strict=True)])
        assert {m.deviation for m in mine} == {deviation} and {m.n for m in mine} == {n}
        assert np.allclose([m.whitened for m in mine], signs * white, atol=1e-7)
        assert np.allclose([m.explained for m in mine], explained, rtol=1e-9)
        assert all(0 <= m.identity_error < 1e-9 for m in mine)


def test_whitening_of_odd_vectors(spark):
    random.seed(3)
    vectors = [[random.uniform(-1, 1) * 10 ** random.randint(0, 6) for _ in range(3)] for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(0, vectors[0])] * 200
    odd = [(1000, None), (1001, [1.0, None, 2.0]), (1002, [1.0, math.nan, 0.0]), (1003, [math.inf, 0.0, 0.0]), (1004, []), (1005, [1.0, 2.0]), (None, vectors[1])]
    frame = spark.createDataFrame([(i, v, "a", 1, "b") for i, v in rows + odd], "vec_id bigint, embedding array<double>, row string, size int, x string").repartition(7)
    white, fitted, errors = whitening.whiten(frame)
    got = white.collect()
    want = plain_whitening(rows)
    assert Counter(r["row"].vec_id for r in got) == Counter([i for i, _ in rows] + [None])
    assert set(fitted) == {2, 3} and not len(fitted[2].values) and errors.keys() == {3}
    assert {(r["row"]["row"], r["row"]["size"], r["row"]["x"]) for r in got} == {("a", 1, "b")}
    signs = None
    for r in got:
        deviation, values, _, _ = want[1 if r["row"].vec_id is None else r["row"].vec_id]
        signs = np.sign(np.array(r.whitened) / values) if signs is None else signs
        assert int(r.deviation) == deviation and np.allclose(r.whitened, signs * values, atol=1e-6)
    assert whitening.whiten(frame.where("false"))[0].count() == 0
    assert whitening.whiten(frame.where("vec_id = 0"))[0].count() == 0


def test_bit_sliced_products_are_exact(spark):
    rng = np.random.default_rng(5)
    huge = rng.integers(-(1 << 50), 1 << 50, (500, 4))
    distinct = spark.createDataFrame([(4, [int(v) for v in row]) for row in huge], "size int, x array<bigint>").repartition(3)
    low = huge.min(axis=0)
    bits = np.array([int(v).bit_length() for v in huge.max(axis=0) - low])
    shifted = (huge - low).astype(object)
    want = shifted.T @ shifted
    got = [[0] * 4 for _ in range(4)]
    for r in distinct.select("x").mapInArrow(whitening._scatter(low, bits), whitening.SUMS).groupBy("limb", "a", "b").sum("total").collect():
        if r.a >= 0:
            got[r.a][r.b] += r["sum(total)"] << 16 * r.limb
    assert all(got[a][b] == want[a, b] for a in range(4) for b in range(a, 4))
    fitted = whitening.fit(distinct)[4]
    deviation, _ = fitted.transform(huge)
    sums = [int(sum(map(int, c))) for c in huge.T]
    assert int(deviation[7]) == sum((500 * int(v) - s) ** 2 for v, s in zip(huge[7], sums, strict=True))


# ---- spot signatures ------------------------------------------------------------------------


def plain_spots(text):
    """The fingerprint as a multiset of word tuples."""
    anchors = {w for own in spot_signatures.ANCHORS.values() for w in own}
    words = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower())
    places = [k for k, w in enumerate(words) if w not in anchors]
    found = Counter()
    for at in [-1, *(k for k, w in enumerate(words) if w in anchors)]:
        first = bisect.bisect_right(places, at)
        after = [words[k] for k in places[first : first + 2]]
        if after:
            found[("" if at < 0 else words[at], *after)] += 1
    return found


def plain_likeness(a, b):
    if not a and not b:
        return 1.0
    return sum((a & b).values()) / sum((a | b).values())


def plain_fingerprints(rows):
    """(doc_id, text) rows in order -> the rows of the query without fingerprints."""
    out = []
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        new = text[: len(text) - third] + following[:third]
        own = plain_spots(text)
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), plain_likeness(own, plain_spots(new)), plain_likeness(own, plain_spots(following))))
    return out


def rounded(rows):
    return Counter((r[0], r[1], r[2], round(r[3], 9), round(r[4], 9)) for r in rows)


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")


@pytest.mark.parametrize("parts", [1, 7])
def test_spot_signatures_query(spark, monkeypatch, parts):
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SMALL}/documents.parquet' ORDER BY doc_id DESC").fetchall()
    monkeypatch.setattr(succession, "PART_BYTES", -(-sum(len(t.encode()) for _, t in rows) // parts))
    monkeypatch.setattr(spot_signatures, "GROUP", 100_000)
    got = spot_signatures.op12_spot_signatures(spark, SMALL).collect()
    assert rounded([tuple(r[c] for c in COLUMNS) for r in got]) == rounded(plain_fingerprints(rows))
    prints = {r.doc_id: r for r in got}
    texts = dict(rows)
    for doc, r in prints.items():
        assert len(spot_signatures.from_hex(r.fingerprint)) == sum(plain_spots(texts[doc]).values())
    by_text = {}
    for doc, text in rows:
        assert by_text.setdefault(text, prints[doc].fingerprint) == prints[doc].fingerprint
    assert len(set(by_text.values())) > 0.9 * len(by_text)


def test_spot_signatures_of_odd_documents(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(succession, "PART_BYTES", 20_000)
    rows = [(r.doc_id, r.text or "", r.k) for r in odd_docs.select("doc_id", "text", succession.order_key(odd_docs.doc_id, succession.plain_text()).alias("k")).collect()]
    rows.sort(key=lambda r: r[2])
    ids = [r[0] for r in rows]
    assert [i for i in ids if i is not None] == sorted((i for i in ids if i is not None), reverse=True) and ids[-2:] == [None, None]
    placed = succession.with_next(odd_docs)
    got = placed.drop("key").mapInArrow(spot_signatures._compare, spot_signatures.FOUND).collect()
    assert rounded([tuple(r[c] for c in COLUMNS) for r in got]) == rounded(plain_fingerprints([r[:2] for r in rows]))
    assert succession.with_next(odd_docs.where("false")).drop("key").mapInArrow(spot_signatures._compare, spot_signatures.FOUND).count() == 0
    one = succession.with_next(odd_docs.where("doc_id = 7")).drop("key").mapInArrow(spot_signatures._compare, spot_signatures.FOUND).collect()
    assert len(one) == 1 and one[0].near_edited == one[0].near_next == 1.0
    named = spot_signatures.fingerprint_documents(odd_docs).collect()
    assert len(named) == odd_docs.count() and {r["row"]["part"] for r in named} == {"p"}
    assert {r.fingerprint for r in named if r.n_spots == 0} == {""}


def test_pruned_likeness_loses_no_pair():
    rng = np.random.default_rng(1)
    for _ in range(300):
        pool = rng.integers(0, 1 << 20, rng.integers(1, 900)).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, max(1, int(len(pool) * rng.uniform(0.1, 1))))) for _ in range(2))
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert spot_signatures.likeness(a, b) == pytest.approx(exact)
        for at_least in (0.3, 0.5, 0.8):
            found = spot_signatures.likeness(a, b, at_least)
            assert found == pytest.approx(exact) if exact >= at_least else found is None
    none = np.zeros(0, np.uint64)
    assert spot_signatures.likeness(none, none, 0.8) == 1.0 and spot_signatures.likeness(none, pool, 0.8) is None


def test_long_words_and_stretches(monkeypatch):
    texts = ["the " + "y" * 3000 + " was here of the sea", "x" * 5000, "", "a b c the " * 900, "short the one"]
    want = [plain_spots(t) for t in texts]
    monkeypatch.setattr(spot_signatures, "STRETCH", 1500)
    monkeypatch.setattr(spot_signatures, "LONG_WORD", 2000)
    assert [len(s) for s in spot_signatures.spots(texts)] == [sum(w.values()) for w in want]
    assert [list(s) for s in spot_signatures.spots(texts[3:])] == [list(s) for s in spot_signatures.spots(texts)[3:]]


# ---- fill in middle -------------------------------------------------------------------------


def plain_middle(doc_id, text, seed=1):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle(spark, odd_docs):
    rows = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    for seed in (1, 2, 3):
        made = fill_in_middle.fill_in_middle(odd_docs, seed)
        back = made.withColumn("back", fill_in_middle.restored(made.output, made.form)).collect()
        got = Counter((r["row"].doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back)
        assert got == Counter(plain_middle(doc, text, seed) for doc, text in rows)
        assert Counter((r["row"].doc_id, r.back) for r in back) == Counter(rows)
        assert {r["row"]["parts"] for r in back} == {"q"}
    assert fill_in_middle.fill_in_middle(odd_docs.where("false")).count() == 0


def test_fill_in_middle_query_matches_sql(spark):
    got = fill_in_middle.op13_fill_in_middle(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    cursor = con.execute(fill_in_middle.OP13_SQL)
    names = [d[0] for d in cursor.description]
    assert got.columns == names and Counter(map(tuple, got.collect())) == Counter(cursor.fetchall())


def test_every_cut_of_the_unit_index():
    for text in ("abc def", "a1b2c3", "ééé", "", "x" * 50, "日a本b語", "ab" * 20 + "é" * 9 + " cd" * 7):
        data = np.frombuffer(text.encode(), np.uint8)
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        for block, window in ((1, 2), (3, 1), (4, 8), (1024, 1024)):
            index = fill_in_middle.UnitIndex(data, block, window)
            assert (index.units, index.points) == (len(units), len(text))
            for k in range(len(units) + 1):
                prefix = "".join(units[:k])
                assert index.cut(k) == (len(prefix.encode()), len(prefix))
