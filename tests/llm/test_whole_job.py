"""Inputs past the bounds that operators once had."""

import gzip
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import components, decontaminate, langid, mixing, warc
from tests.llm.helpers import documents


def test_components_of_far_apart_ids(spark):
    first = 200 << 33
    star = spark.range(6_000_000).select((F.col("id") + first).alias("u"), F.lit(0).cast("long").alias("v"))
    assert components._state(star)[2] == 6_000_000 * first + 6_000_000 * 5_999_999 // 2
    far = 1 << 62
    edges = spark.createDataFrame([(far + k, k % 2) for k in range(8)] + [(5, 6)], "u long, v long")
    found = {r.node: r.root for r in components.components(edges).collect()}
    assert found == {far + k: k % 2 for k in range(8)} | {6: 5}


def test_a_page_with_a_long_url_comes_back(spark):
    rows = [(1, "http://a/" + "x" * (1 << 21), "one"), (2, "http://b/", "one"), (3, "http://c/", "two")]
    found = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {(r.page_id, r.record_type) for r in found.collect()} == {(1, "response"), (2, "revisit"), (3, "response")}


def test_a_gap_in_a_written_archive_is_an_error(spark, monkeypatch):
    pages = spark.createDataFrame([("a", "http://a/", "one"), ("c", "http://c/", "two")], "page_id string, url string, html string")
    real = warc.record_text
    monkeypatch.setattr(warc, "record_text", lambda rows: F.regexp_replace(real(rows), "<urn:page:a>", "\r\n"))
    with pytest.raises(Exception, match="gap in an archive just written"):
        warc.round_trip(pages).collect()


def test_ids_of_any_content_come_back(spark):
    ids = ["a\r\n\r\nb", "", " ", "<urn:page:x>", "a%20b+c", "é 中\t", None, "null", ">"]
    pages = spark.createDataFrame([(i, "http://a/", f"body {k}") for k, i in enumerate(ids)], "page_id string, url string, html string")
    assert {r.page_id for r in warc.round_trip(pages).collect()} == set(ids)
    twins = spark.createDataFrame([("", "u", "same"), ("x", "u", "same"), (None, "u", "same")], "page_id string, url string, html string")
    assert {(r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(twins).collect()} == {
        ("", "response", None), ("x", "revisit", ""), (None, "revisit", "")}


def test_archives_roll_by_bytes(spark, tmp_path):
    sizes = [10] * 60 + [3000] * 7 + [40_000] * 3 + [200_000]
    pages = spark.createDataFrame([(i, "u", chr(97 + i % 26) * n + str(i)) for i, n in enumerate(sizes)], "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.write_archives(pages.coalesce(1), path, file_records=20, file_bytes=50_000)
    files = [f for f in os.listdir(path) if f.endswith(".txt")]
    heavy = [os.path.getsize(os.path.join(path, f)) for f in files]
    assert sum(n > 50_000 for n in heavy) == 1 and len(files) >= 4
    found = warc.read_archives(spark, path)
    assert found.filter("kind = 'record'").count() == len(sizes) and found.filter("kind = 'gap'").count() == 0
    per_file = found.groupBy("file").count().collect()
    assert max(r["count"] for r in per_file) <= 20
    empty = str(tmp_path / "none")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_hundreds_of_languages_are_learned(spark):
    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(200):
        words = ["".join(rnd.choice(letters) for _ in range(6)) for _ in range(12)]
        rows += [(len(rows) + j, " ".join(rnd.choices(words, k=40)), f"l{k:03d}", "s") for j in range(4)]
    found = langid.language_id(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    right = {r[0]: r[2] for r in rows}
    learned = {right[r.doc_id] for r in found if not r.held_out}
    held = [r for r in found if r.held_out and right[r.doc_id] in learned]
    assert sum(r.lang_pred == right[r.doc_id] for r in held) >= 0.95 * len(held) > 50


def test_codewords_of_many_languages():
    for n in (8, 130, 1500):
        code = langid.codewords(n)
        assert code.shape == (n, -(-10 * np.log2(n) // 1)) and not (np.abs(code.sum(0, dtype=int)) == n).any()
        brute = min(int((code[i] != code[j]).sum()) for i in range(0, n, max(1, n // 40)) for j in range(n) if i != j)
        assert 0 < langid._least_distance(code) <= brute


def record(i, body):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:"
    return head.encode() + warc.sha1_base32(body).encode() + f"\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def salvaged(data):
    found = list(warc.salvage(data))
    return ([x["fields"]["warc-record-id"][10:-1] for what, _, _, x in found if what == "record"],
            [(a, b, x) for what, a, b, x in found if what == "gap"])


@pytest.mark.parametrize("level", [0, 9])
def test_good_records_of_a_damaged_member_come_back(level):
    rng = random.Random(5)
    parts = [record(i, rng.randbytes(3000)) for i in range(6)]
    last = gzip.compress(record(9, b"later"), mtime=0)

    # one bad record in a member that is whole
    bad = bytearray(b"".join(parts))
    bad[len(parts[0]) + len(parts[1]) - 100] ^= 0xFF
    member = gzip.compress(bytes(bad), level, mtime=0)
    ids, gaps = salvaged(member + last)
    assert ids == ["0", "2", "3", "4", "5", "9"]
    (start, end, reason), = gaps
    assert (start, end) == (0, len(member))
    assert f"(bytes {len(parts[0])} to {len(parts[0]) + len(parts[1])} of the member that starts at 0)" in reason

    # a member that is cut off
    member = gzip.compress(b"".join(parts), level, mtime=0)
    cut = member[:len(member) * 3 // 4]
    ids, gaps = salvaged(cut + last)
    assert ids == ["0", "1", "2", "3", "9"] and all(gap[:2] == (0, len(cut)) for gap in gaps) and gaps
    assert salvaged(cut)[0] == ["0", "1", "2", "3"]


def test_test_blocks_are_scanned_in_separate_passes(spark):
    note = " ".join(f"word{k}" for k in range(60))
    items = spark.createDataFrame([(k, " ".join(f"word{j}" for j in range(5 * k, 5 * k + 10))) for k in range(9)], "item_id long, text string")
    docs = spark.createDataFrame([(1, note), (1, note), (None, "x " + note), (2, None), (3, "nothing")], "doc_id long, text string")
    blocks = decontaminate.test_blocks(items, 250)
    assert len(blocks) > 2 and all(b.count() <= 3 for b in blocks)
    assert sorted(r.item_id for b in blocks for r in b.collect()) == [str(k) for k in range(9)]
    several = decontaminate.contamination(docs, items, block_bytes=250)
    # no document row passes more than the scan of one block
    assert several._jdf.queryExecution().optimizedPlan().toString().count("scan_texts") == 0
    one = decontaminate.contamination(docs, items)
    columns = [c for c in one.columns if c != "matches"]
    assert sorted(map(str, several.select(columns).collect())) == sorted(map(str, one.select(columns).collect()))
    places = lambda df: sorted((str(r.doc_id), sorted(map(str, r.matches))) for r in df.collect())
    assert places(several) == places(one)
    kept = decontaminate.drop_contaminated(docs, items, block_bytes=250)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3] and kept.columns == docs.columns


def test_sources_never_meet_in_one_task(spark):
    sizes = spark.range(3000).select(F.lit(False).alias("no_source"), F.concat(F.lit("s"), "id").alias("source"), (F.col("id") * 7919 % 1009).alias("size"))
    found = mixing.targets(sizes)
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
    rows = {r.source: (r.source_size, r.target) for r in found.collect()}
    caps = {s: (2 * rows[s][0], mixing.WEIGHTS[k % 3]) for k, s in enumerate(sorted(rows))}
    left, weight = 1.5 * sum(n for n, _ in rows.values()), sum(w for _, w in caps.values())
    for cap, w in sorted(caps.values(), key=lambda x: x[0] / x[1]):
        if left / weight <= cap / w:
            break
        left, weight = left - cap, weight - w
    assert len(rows) == 3000
    assert all(abs(rows[s][1] - min(cap, w * left / weight)) < 1e-6 for s, (cap, w) in caps.items())


def test_repetition_is_scanned_in_bounded_memory():
    """A test item and a document of one repeated word: windows are opened once, and
    the longest matches some places at a time."""
    import tracemalloc

    test = decontaminate.TestSet([("x", [b"a"] * 200), ("y", [b"a"] * 40 + [b"b"])], 10)
    for matches, most in ((False, 60), (True, 250)):
        tracemalloc.start()
        (row,) = decontaminate.scan([[b"a"] * 200_000], test, matches)
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert row["hits"] == [{"first": 0, "end": 200_000}] and row["items"] == ["x", "y"] and peak < most
    longest = [m for m in row["matches"] if m["item_id"] == "x"]
    assert len(longest) == 200_000 - 9


@pytest.mark.parametrize("places", [1, 7, 1 << 20])
def test_windows_and_longest_matches_are_those_of_brute_force(places, monkeypatch):
    monkeypatch.setattr(decontaminate, "PLACES", places)
    rnd = random.Random(9)
    for _ in range(40):
        docs = [[rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randint(0, 30))] for _ in range(4)]
        items = [(f"i{k}", [rnd.choice([b"a", b"b"]) for _ in range(rnd.randint(0, 12))]) for k in range(3)]
        got = decontaminate.scan(docs, decontaminate.TestSet(items, 4))
        without = decontaminate.scan(docs, decontaminate.TestSet(items, 4), matches=False)
        text = [tuple(d) for d in docs]
        for d, row, bare in zip(text, got, without):
            hit, found = set(), set()
            for i, w in items:
                n = min(4, len(w))
                for j in range(len(w) - n + 1 if n else 0):
                    for p in range(len(d) - n + 1):
                        if d[p:p + n] == tuple(w[j:j + n]):
                            hit |= set(range(p, p + n))
                            found.add(i)
            assert {x for r in row["hits"] for x in range(r["first"], r["end"])} == hit and row["items"] == sorted(found)
            assert (bare["hits"], bare["items"], bare["matches"]) == (row["hits"], row["items"], [])
            for m in row["matches"]:
                w, j, p, n = dict(items)[m["item_id"]], m["item_word"], m["doc_word"], m["n_words"]
                assert d[p:p + n] == tuple(w[j:j + n])
                assert not (j and p and d[p - 1] == w[j - 1]), "not extended to the left"
        for i, w in items:  # every window that occurs has a longest match at a place where no match is longer
            for j in range(len(w) - 3 if len(w) >= 4 else 0):
                best = max((n for n in range(4, len(w) - j + 1) for d in text for p in range(len(d) - n + 1) if d[p:p + n] == tuple(w[j:j + n])),
                           default=0)
                here = [m["n_words"] for row in got for m in row["matches"] if (m["item_id"], m["item_word"]) == (i, j)]
                assert all(n == best for n in here)
