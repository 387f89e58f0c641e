"""Language id, quality classifier, WARC, n-gram join, pipeline."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from starloom.llm import catalog, langid, mixing, ngram_join, quality, warc
from starloom.llm.components import components
from tests.llm.helpers import ROWS, documents, parquet, same_as_sql, words

SF = "/root/testdata/sf0.001"


# language id

def test_codewords():
    assert langid.codewords(4).shape == (4, 7) and langid.codewords(1).shape == (1, 0)
    big = langid.codewords(30)
    assert min((big[i] != big[j]).sum() for i in range(30) for j in range(i)) >= 10


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found.held_out]
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]).all()
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_language_id_edge_rows(spark):
    rows = documents(spark)
    found = langid.language_id(rows)
    assert found.count() == rows.count()
    for r in found.filter("doc_id in (4, 5, 6, 9)").collect():
        assert r.lang_pred == "und" and r.score == 0
    assert langid.language_id(documents(spark, [])).count() == 0
    unlabelled = documents(spark, [(1, "some words", None, None)])
    assert langid.language_id(unlabelled).first().lang_pred == "und"
    one = documents(spark, [(i, "some words", "en", None) for i in range(8)])
    assert {r.lang_pred for r in langid.language_id(one).collect()} == {"en"}


# quality

def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = quality.quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    held = found[found.held_out]
    assert (held.predicted == held.quality).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_quality_edge_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, None), (4, None, None), (None, 1, 0), (99, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0), labels.filter("quality = 1")):
        found = quality.quality_scores(docs, marks)
        assert found.count() == docs.count() and found.filter("score between 0 and 1").count() == docs.count()
    assert quality.quality_scores(documents(spark, []), labels).count() == 0
    kept = quality.drop_poor(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = np.where(x[:, 0] - x[:, 1] > 0, 1.0, -1.0)
    w = quality.dual_coordinate_descent([np.arange(3)] * 200, list(x), y, 3, cost=10, rounds=200)
    assert (np.sign(x @ w[:3] + w[3]) == y).mean() > 0.98


# WARC

def pages(spark, tmp_path):
    rows = [(3, "http://a/", "<p>é</p>", "z"), (1, "http://b/", "<p>é</p>", "z"), (2, None, None, "z"), (5, "u\r\nv w", "", "z"),
            (None, "n", "", "z"), (None, "n", "only without id", "z"), (7, "x", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n", "z"),
            (7, "x", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n", "z"), (8, "y", "long " * 100_000, "z")]
    return parquet(spark, spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string"), tmp_path, "pages")


def test_round_trip_matches_sql(spark, tmp_path):
    found = warc.round_trip(pages(spark, tmp_path)).drop("file", "start", "end")
    same_as_sql(found, warc.SQL, tmp_path, "pages")
    assert warc.round_trip(pages(spark, tmp_path).limit(0)).count() == 0


def test_payloads_come_back(spark, tmp_path):
    p = pages(spark, tmp_path)
    warc.write_archives(p, str(tmp_path / "out"), file_records=2)
    found = warc.read_archives(spark, str(tmp_path / "out"), payloads=True)
    assert found.filter("kind = 'gap'").count() == 0
    got = {r.payload_digest: bytes(r.payload).decode() for r in found.filter("record_type = 'response'").collect()}
    assert set(got.values()) == {r.html or "" for r in p.collect()}
    assert all(warc.sha1_base32(t.encode()) == d for d, t in got.items())


def one(i, body=b"hello"):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:"
    return head.encode() + warc.sha1_base32(body).encode() + f"\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def read(data):
    found = list(warc.salvage(data))
    at = 0
    for what, start, end, _ in found:
        if (what, start) != ("record", at) or start >= at:
            assert start in (at, start)
        at = max(at, end)
    assert at == len(data)
    return [r["fields"]["warc-record-id"][10:-1] for w, _, _, r in found if w == "record"], [(s, e) for w, s, e, _ in found if w == "gap"]


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage_recovers_later_records(zipped):
    parts = [one(i, b"body %d WARC/1.1\r\n" % i * 3) for i in range(5)]
    if zipped:
        parts = [gzip.compress(p, mtime=0) for p in parts]
    assert read(b"".join(parts)) == (["0", "1", "2", "3", "4"], [])
    place = len(parts[0]) + len(parts[1]) // 2
    broken = bytearray(b"".join(parts))
    broken[place] ^= 0xFF
    ids, gaps = read(bytes(broken))
    assert ids == ["0", "2", "3", "4"] and gaps == [(len(parts[0]), len(parts[0]) + len(parts[1]))]
    ids, gaps = read(b"junk" + b"".join(parts)[:-9])
    assert ids == ["0", "1", "2", "3"] and gaps[0] == (0, 4) and len(gaps) == 2
    assert read(b"") == ([], [])


@pytest.mark.parametrize("seed", range(20))
def test_salvage_accounts_for_every_byte(seed):
    rng = random.Random(seed)
    data = bytearray(b"".join(one(i, rng.randbytes(rng.randint(0, 60))) for i in range(8)))
    for _ in range(rng.randint(0, 5)):
        at = rng.randrange(len(data))
        data[at:at + rng.randint(0, 30)] = rng.randbytes(rng.randint(0, 30))
    read(bytes(data))


# n-gram join

def near_copies(n=30, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(6):
        text = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(n if g == 0 else 4):
            copy = list(text)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) + 100, " ".join(copy), "en", "a"))
    return rows


def test_join_matches_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL", 3)  # buckets and blocks of either kind
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text", "lang", "source").collect()] + near_copies()
    docs = parquet(spark, documents(spark, rows), tmp_path)
    same_as_sql(ngram_join.jaccard_join(docs), ngram_join.SQL, tmp_path, "documents")
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    classes = ngram_join.jaccard_join(docs).filter("n_grams > 0").select("class_id").distinct().count()
    assert kept.filter("length(text) > 3").count() == classes


def test_join_with_blocks_of_few_ngrams(spark, tmp_path, monkeypatch):
    """Near copies of long and short texts: blocks are bounded by n-grams too, and the rows are the same."""
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 150)
    monkeypatch.setattr(ngram_join, "SMALL", 4)
    rnd = np.random.default_rng(4)
    rows = []
    for size in (12, 60, 400):
        base = [f"w{x}" for x in rnd.integers(0, 5000, size)]
        for k in range(9):
            near = list(base)
            near[k % size] = f"x{k // 2}"
            rows.append((len(rows), " ".join(near), "en", "a"))
    rows += [(r[0] + 100, r[1], "en", "a") for r in rows[:6]] + [rows[0], (None, rows[1][1], "en", "a")]
    docs = parquet(spark, documents(spark, rows), tmp_path)
    same_as_sql(ngram_join.jaccard_join(docs), ngram_join.SQL, tmp_path, "documents")


def alike_pages(rng, n, share, words=60):
    """Pages of one template that agree on a share of their words, each with near copies of its own."""
    template = [f"t{k}" for k in range(int(words * share))]
    rows = []
    for i in range(n):
        page = template + [f"w{rng.randrange(10 ** 6)}" for _ in range(words - len(template))]
        rows.append(" ".join(page))
        if i % 5 == 0:
            rows.append(" ".join(page[:-1]))
    return rows


def test_alike_pages_fall_apart_before_texts_move(spark, tmp_path, monkeypatch):
    """A large bucket ties pages of one template; the comparison of MinHash values parts them, and links are those of SQL."""
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "SIGNATURES", 30)
    rng = random.Random(3)
    texts = alike_pages(rng, 60, 0.6) + alike_pages(rng, 10, 0.97)
    docs = parquet(spark, documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]), tmp_path)
    rows = ngram_join._signed(docs.select("doc_id", "text"))
    nodes = rows.withColumnRenamed("doc_id", "node")
    tied = ngram_join.components(ngram_join._candidates(nodes, 0.8, 1e-9))
    left = ngram_join._pruned(nodes, tied, 0.8, 1e-9)
    assert tied.groupBy("root").count().agg({"count": "max"}).first()[0] >= 50
    sizes = sorted(r["count"] for r in left.groupBy("root").count().collect())
    assert sizes[-1] < 20 and sizes.count(1) >= 10
    same_as_sql(ngram_join.jaccard_join(docs), ngram_join.SQL, tmp_path, "documents")


def test_join_of_nothing(spark):
    assert ngram_join.jaccard_join(documents(spark, [])).count() == 0
    alone = documents(spark, [(1, "a b", None, None), (2, None, None, None), (3, "", None, None)])
    assert {(r.doc_id, r.class_id, r.n_links) for r in ngram_join.jaccard_join(alone).collect()} == {(1, 1, 0), (2, 2, 0), (3, 3, 0)}


def test_pruning_keeps_pairs_at_the_threshold():
    least = ngram_join.least_matches(0.8, 1e-9)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    a, b = np.unique(base[:360]), np.unique(base[40:])  # similarity 320 / 400
    sig = np.vstack([ngram_join.signature(a), ngram_join.signature(b)])
    assert len(ngram_join.survivors(sig, sig, np.array([0]), np.array([1]), least)) == 1
    far = np.vstack([ngram_join.signature(a), ngram_join.signature(rng.integers(0, 1 << 63, 400).astype(np.uint64))])
    assert len(ngram_join.survivors(far, far, np.array([0]), np.array([1]), least)) == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (10, 9), (9, 8), (8, 7), (7, 6), (6, 5), (20, 21), (21, 20)]
    found = components(spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in found.collect()} == {(2, 1), (3, 1), (6, 5), (7, 5), (8, 5), (9, 5), (10, 5), (21, 20)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# pipeline

def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        assert docs.columns == columns
        kept[name] = {r.doc_id for r in docs.collect()}
        assert kept[name] <= set(before)
        if name == "exact_dedup":
            best = {}
            for i, t in before.items():
                key = hashlib.sha256("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r").encode()).digest()
                best[key] = min(best.get(key, (1, 0)), (-len(t or ""), i))
            assert kept[name] == {i for _, i in best.values()}
        if name == "ngram_jaccard_join":
            sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := words(t)) else set() for i, t in before.items()}
            low = {i: i for i in sets}
            ids = sorted(sets)
            changed = True
            pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
                     and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
            while changed:
                changed = False
                for a, b in pairs:
                    m = min(low[a], low[b])
                    changed |= (low[a], low[b]) != (m, m)
                    low[a] = low[b] = m
            assert kept[name] == set(low.values())
        if name == "decontamination":
            items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            windows = {tuple(w[k:k + 10]) for w in items if w for k in range(max(1, len(w) - 9))}
            sizes = {len(w) for w in windows}
            bad = {i for i, t in before.items() if any(tuple(w[k:k + n]) in windows for w in [words(t)] for n in sizes for k in range(len(w) - n + 1))}
            assert kept[name] == set(before) - bad
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    all_ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = [i in kept["quality_classifier"] for i in all_ids if marks.get(i) == 1]
    assert sum(good) / len(good) > 0.97
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in mixed.collect()} == kept["decontamination"]
    assert mixed.exceptAll(mixing.mix(docs)).count() == 0


def test_stages_take_empty_and_odd_tables(spark):
    for rows in ([], None):
        docs = documents(spark, rows) if rows is not None else documents(spark)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "mixing" or out.columns == docs.columns
            assert len(out.collect()) <= len(rows if rows is not None else ROWS)


@pytest.mark.parametrize("key", sorted(catalog.ORACLE))
def test_queries_match_their_sql(spark, key, tmp_path):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(catalog.ORACLE[key])
    names = [d[0] for d in cursor.description]
    found = catalog.QUERIES[key](spark, SF)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in found.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


