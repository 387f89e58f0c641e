"""Exact dedup and mixing."""

from pyspark.sql import functions as F

from starloom.llm import exact_dedup, mixing
from tests.llm.helpers import documents, parquet, same_as_sql


def test_exact_groups_match_sql(spark, tmp_path):
    docs = parquet(spark, documents(spark).filter("doc_id <> 2 or doc_id is null"), tmp_path)
    same_as_sql(exact_dedup.exact_groups(docs), exact_dedup.SQL, tmp_path, "documents")


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark).repartition(7)
    found = exact_dedup.exact_groups(docs, fan_in=2).toPandas()
    assert len(found) == docs.count()
    assert (found.groupby("text_sha256")["kept"].sum() == 1).all()
    kept = exact_dedup.drop_copies(docs, fan_in=2)
    assert kept.columns == docs.columns
    assert kept.count() == found["text_sha256"].nunique()
    # the longest original text, then the smallest id; a null id is last
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {3, 6, 7, 8, 9, None, 10}


def test_runs_are_merged_in_binomial_rounds(spark, monkeypatch):
    assert [exact_dedup.rounds(n) for n in (1, 2, 3, 5, 16, 17)] == [0, 1, 2, 3, 4, 5]
    assert [exact_dedup.rounds(n, 4) for n in (1, 2, 5, 16, 17)] == [0, 1, 2, 2, 3]
    merged = []
    real = exact_dedup._merged
    monkeypatch.setattr(exact_dedup, "_merged", lambda rows, tasks: merged.append(real(rows, tasks)) or merged[-1])
    rows = [(i, f"text {i % 7}" + " " * (i % 3), "en", "a") for i in range(40)]
    for n in (1, 2, 5, 16):
        merged.clear()
        runs = exact_dedup.digest_runs(documents(spark, rows).repartition(n))
        found = exact_dedup.merge_runs(runs)
        # the runs themselves are put in order first, then one merge a round, whatever the size
        assert len(merged) == 1 + exact_dedup.rounds(n)
        assert [m.select("run").distinct().count() for m in merged] == [-(-n // 2 ** k) for k in range(len(merged))]
        assert {(r.keep_id, r.group_size) for r in found.collect()} == {
            (min((j for j in range(40) if j % 7 == i), key=lambda j: (-(j % 3), j)), sum(j % 7 == i for j in range(40))) for i in range(7)}
        plan = merged[-1]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == len(merged), "a merge moves the runs once and sorts where they meet"


def test_unique_rows_pass_without_a_shuffle(spark):
    rows = [(i, "word " * 50 + str(i if i % 10 else i % 20), "en", "a") for i in range(400)]
    docs = documents(spark, rows).repartition(4)
    for bits in (exact_dedup.MAP_BITS, 1 << 15):
        kept = exact_dedup.drop_copies(docs, bits=bits)
        assert kept.count() == 360 + 2
    left = kept._jdf.queryExecution().executedPlan().toString().split("Union")[1].split("Exchange hashpartitioning")[0]
    assert "BroadcastHashJoin" in left
    maps = exact_dedup.repeated_bits(spark.range(10 ** 5).select(F.xxhash64("id").alias("check")), 1 << 18)
    assert maps.count() == 8 and maps.select(F.sum(F.octet_length("bits"))).first()[0] == 8 * 4096


def test_fan_in_does_not_matter(spark):
    docs = documents(spark).repartition(9)
    a, b = (exact_dedup.exact_groups(docs, fan_in=f).select("doc_id", "keep_id", "group_size", "text_sha256") for f in (2, 64))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dedup_and_mix_of_nothing(spark):
    none = documents(spark, [])
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0
    assert mixing.mix(none).count() == 0


def test_mix_matches_sql(spark, tmp_path):
    rows = [(i, "w " * (1 + i * 7 % 40), "en", [None, "a", "b", "c", "é"][i % 5]) for i in range(400)]
    docs = parquet(spark, documents(spark, rows), tmp_path)
    for bins in (mixing.BINS, 4):
        found = mixing.mix(docs, bins=bins)
        same_as_sql(found.select("doc_id", "size", "source_size", "target", "taken"), mixing.SQL, tmp_path, "documents")
    per = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most"))
    for r in per.collect():
        assert abs(r.taken - r.target) <= r.most
    assert found.filter("taken > 2 * size").count() == 0


def test_mix_edge_rows(spark):
    docs = documents(spark)
    found = mixing.mix(docs)
    assert found.count() == docs.count()
    assert found.filter("size = 0 and taken <> 0").count() == 0
    again = mixing.mix(docs.repartition(5))
    assert found.exceptAll(again).count() == 0
    assert mixing.mix(documents(spark, [(1, None, None, None), (2, "", None, "a")])).agg(F.sum("taken")).first()[0] == 0


def test_native_plans_have_no_python(spark):
    docs = documents(spark)
    for df in (mixing.mix(docs), exact_dedup.exact_groups(docs), exact_dedup.drop_copies(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_odds_differ_by_document_and_meet_the_targets(spark):
    rows = [(i, "w " * (1 + i % 300), "en", "abc"[i % 3]) for i in range(3000)]
    sizes = mixing.sized(documents(spark, rows))
    classes = mixing.copies_by_size(sizes, mixing.targets(sizes)).collect()
    for source in "abc":
        mine = sorted((r for r in classes if r.source == source), key=lambda r: r.digits)
        copies = [r.whole + r.p for r in mine]
        assert copies == sorted(copies) and max(copies) <= 2
        words = {r.digits: sum(1 + i % 300 for i in range(3000) if "abc"[i % 3] == source and (1 + i % 300).bit_length() == r.digits) for r in mine}
        assert abs(sum(c * words[r.digits] for c, r in zip(copies, mine)) - mine[0].target) < 1e-6 * mine[0].target
        assert mine[0].target == 2 * mine[0].source_size or len({r.p for r in mine}) > 1, "a source that isn't capped has unequal odds"
    found = mixing.mix(documents(spark, rows)).collect()
    for source in "abc":
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)
        short, long_ = ([r.copies for r in mine if lo <= r.size < hi] for lo, hi in ((2, 16), (128, 301)))
        assert sum(long_) / len(long_) >= sum(short) / len(short)
