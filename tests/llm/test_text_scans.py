"""Licence scan, personal data, token counts, decontamination."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import decontaminate, licenses, pii, tokens
from starloom.llm import common
from tests.llm.helpers import LONG, NOTE, documents, parquet, same_as_sql, words


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_are_those_of_the_pattern(text):
    assert [w.decode() for w in common.words(text)] == words(text)


# licences

LICENCES = [
    (1, "Released under the MIT License. UNDER THE MIT LICENSE", None, None),
    (2, "Licensed under the Apache License, Version 2.0.", None, None),
    (3, "Licensed under CC BY-NC 4.0.", None, None),
    (4, "This work is licensed under the GNU General Public License, version 3.", None, None),
    (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the software without restriction", None, None),
    (6, "the apache license version two", None, None),
    (7, "gnu gnu gnu public license general version 3", None, None),
    (8, None, None, None), (9, "", None, None), (10, LONG + " under the mit license " + LONG, None, None),
    (11, "plain words about nothing", None, None), (11, "plain words about nothing", None, None),
]


def test_license_scan(spark):
    found = {r.doc_id: r for r in licenses.license_scan(documents(spark, LICENCES)).collect()}
    base = {1: (2, 1, 5, "mit"), 2: (1, 3, 3, "apache-2"), 3: (1, 2, 2, "cc-by-nc"), 10: (1, 24000, 24000, "mit")}
    for i, r in found.items():
        assert (r.n_base, r.first_word, r.last_word, r.base_labels) == base.get(i, (0, None, None, "")), i
        assert r.n_words == len(words(dict((k, t) for k, t, _, _ in LICENCES)[i]))
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
    assert found[4].labels == "gpl-3" and found[5].labels == "mit" and found[7].labels == "" and found[11].labels == ""
    assert licenses.license_scan(documents(spark, [])).count() == 0


def test_every_template_finds_itself():
    index = licenses.Index(1000, {w: 500 for w in (b"the", b"of", b"to", b"a", b"and", b"this", b"in", b"is")})
    for label, text, _ in licenses.TEMPLATES:
        filler = "lorem ipsum " * 50
        assert label in index.scan(common.words(filler + text + " " + filler))["labels"].split(","), text


# personal data

def brute_spans(text):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 12 <= len(d) <= 19 and sum(d[0::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0:
            out.append((m.start(), m.end(), 2))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


@given(st.text(alphabet="a1@.+ -()_%0569éZ", max_size=50))
@settings(max_examples=1500, deadline=None)
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == brute_spans(text)


PRIVATE = [
    (1, "Call +49 155 5123 4567 now. Later 4915551234567 answers. Mail Bob.X@mail.com or bob.x@mail.com", None, None),
    (2, "Host 10.0.0.1 and 999.1.1.1, card 4111 1111 1111 1111 or 4111-1111-1111-1112", None, None),
    (3, None, None, None), (4, "", None, None), (5, "1" * 50_000 + "a." * 20_000 + "@" * 1000, None, None),
    (6, "no data", None, None), (6, "no data", None, None), (7, "number 4915551234567 alone", None, None),
] + [(100 + i, f"id 49155512345{i:02d} of parcel, +1 (555) 010-{i:04d}, a{i}@b.org, again +1 (555) 010-{i:04d}", None, None)
     for i in range(40)]


def test_personal_data(spark):
    found = {r.doc_id: r for r in pii.personal_data(documents(spark, PRIVATE)).collect()}
    for i, text, _, _ in PRIVATE:
        base = brute_spans(text or "") if len(text or "") < 10_000 else pii.base_spans(text)
        written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
        r = found[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(written.split(",")) <= set(r.spans.split(",")) | {""}
    # the bare digits of a phone number are one beside it, and nothing alone
    assert "phone:34:47" in found[1].spans and found[7].spans == ""
    assert pii.personal_data(documents(spark, [])).count() == 0


def test_field_is_consistent_over_repeats():
    counts = {("node 11+( -0", "3"): 50, ("node 110", "4"): 50, ("skip 3", "3"): 20, ("skip 4", "4"): 20}
    field = pii.Field(counts)
    text = "+1 (555) 010-1234 " + "x " * 500 + "15550101234"
    assert [k for _, _, k in field.spans(text)] == [3, 3]
    assert np.allclose(field.beliefs(pii.units_of(text)).sum(1), 1)


def planted(seed, n=400):
    """Texts with personal data, later repeats that no pattern matches (no plus sign, one wrong digit of a card),
    and unrelated numbers of the same shapes; and the places of the repeats."""
    rng = random.Random(seed)
    texts, truth = [], []
    for i in range(n):
        number = "".join(rng.choice("123456789") for _ in range(10))
        phone = f"+1 ({number[:3]}) {number[3:6]}-{number[6:]}"
        card = next(c for c in ("4" + "".join(rng.choice("0123456789") for _ in range(15)) for _ in iter(int, 1)) if pii.luhn(c))
        other = next(c for c in ("4" + "".join(rng.choice("0123456789") for _ in range(15)) for _ in iter(int, 1)) if not pii.luhn(c))
        typo = rng.randrange(16)
        typo = card[:typo] + str((int(card[typo]) + 1) % 10) + card[typo + 1:]
        parts = ["noise"] * rng.randrange(5, 200) + [phone] * (i % 3 > 0) + [card] * (i % 4 > 0)
        rng.shuffle(parts)
        extra = [("1" + number, "phone") if i % 3 else ("word", None), (typo, "card") if i % 4 else ("word", None),
                 ("1" + "".join(rng.choice("123456789") for _ in range(10)), None), (other, None)]
        for word, kind in extra:
            if rng.random() < 0.5:
                parts.insert(rng.randrange(len(parts) + 1), (word, kind))
        text, found = "", set()
        for p in parts:
            word, kind = p if isinstance(p, tuple) else (p, None)
            if kind:
                found.add((len(text), len(text) + len(word), pii.KINDS.index(kind)))
            text += word + " some words, "
        texts.append(text)
        truth.append(found)
    return texts, truth


def added(field, text):
    return set(field.spans(text)) - set(pii.base_spans(text))


@pytest.mark.parametrize("seed", range(4))
def test_planted_repeats_are_added_and_nothing_else(spark, seed):
    texts, truth = planted(seed)
    counts = pii.count_potentials(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]))
    field = pii.Field(counts)
    # held out: other texts than the potentials were counted on
    texts, truth = planted(seed + 100)
    found = [added(field, t) for t in texts]
    right = sum(len(f & t) for f, t in zip(found, truth))
    assert sum(map(len, truth)) > 200
    assert right / sum(map(len, found)) >= 0.98  # precision
    assert right / sum(map(len, truth)) >= 0.98  # recall
    # texts without personal data are left alone
    assert not any(added(field, f"order {10 ** 10 + 7919 * i} of card 4{10 ** 14 + 104729 * i}") for i in range(300)
                   if not pii.base_spans(f"order {10 ** 10 + 7919 * i} of card 4{10 ** 14 + 104729 * i}"))


def test_links_that_chance_brings_are_worth_nothing():
    """Consecutive numbers are all similar to a span and to its decoy: no span is added by similarity."""
    rng, texts = random.Random(5), []
    for i in range(300):
        first = rng.randrange(10 ** 10) * 100
        run = [f"4{first + j:015d}"[:16] for j in range(100)]
        texts.append("serial numbers " + " and ".join(run))
    counts = Counter()
    for t in texts:
        counts.update(pii.counts_of(t))
    field = pii.Field(counts)
    assert counts["similar", "2"] > 1000 and field.similar.max() < 1.0
    counts = Counter()
    for t in planted(1)[0]:
        counts.update(pii.counts_of(t))
    assert pii.Field(counts).similar[2, 2] > 5 and pii.Field(counts).skip[3, 3] > 5


@given(st.lists(st.text(alphabet="01", min_size=8, max_size=11), max_size=12), st.lists(st.text(alphabet="01", min_size=8, max_size=20), max_size=8))
@settings(max_examples=300, deadline=None)
def test_similar_numbers_are_those_of_all_pairs(spans, others):
    want = {}
    for j, y in enumerate(others):
        near = [i for i, x in enumerate(spans) if len(x) == len(y) and 9 <= len(x) <= 19 and sum(a != b for a, b in zip(x, y)) == 1]
        if near and y not in spans:
            want[j] = near[0]
    assert pii.similar(spans, ["" if y in spans else y for y in others]) == want


# token counts

@pytest.fixture(scope="module")
def model():
    return tokens.load(tokens.model_path())


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\n▁aé<s>/x中　\x00the"), st.characters(codec="utf-8")), max_size=40), max_size=4))
@settings(max_examples=200, deadline=None)
def test_counts_are_the_librarys(model, texts):
    assert tokens.Counts(tokens.model_path()).of(texts) == [len(model.encode(t)) for t in texts]


def test_token_counts(spark, model):
    docs = documents(spark)
    found = tokens.token_counts(docs)
    assert found.count() == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    for r in found.filter("doc_id is not null").collect():
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), len(model.encode(texts[r.doc_id])))
        assert r.over_limit == (r.n_tokens > 4096)
    assert tokens.token_counts(documents(spark, [])).count() == 0


def test_a_full_table_starts_anew(model):
    counts = tokens.Counts(tokens.model_path(), table_tokens=5)
    for text in ("a b c d e f g h", "a b", "x y z " * 9, "a b c d e f g h"):
        assert counts.of([text]) == [len(model.encode(text))]


# decontamination

ITEMS = [(1, NOTE), (2, "short text"), (3, "one two three four five six seven eight nine ten"), (4, None), (5, ""), (None, "中文 😀"),
         (10, "never there at all")]


def bench(spark, tmp_path):
    return parquet(spark, spark.createDataFrame([(i, t, "z") for i, t in ITEMS], "item_id long, text string, key string"),
                   tmp_path, "benchmark")


def test_contamination_matches_sql(spark, tmp_path):
    rows = [r for r in documents(spark).select("doc_id", "text", "lang", "source").collect()]
    rows = [tuple(r) for r in rows] + [(20 + i, NOTE[i:] + " short text " + NOTE[:40 + i], "en", "a") for i in range(12)]
    docs = parquet(spark, documents(spark, rows), tmp_path)
    items = bench(spark, tmp_path)
    same_as_sql(decontaminate.contamination(docs, items).drop("matches"), decontaminate.SQL, tmp_path, "documents", "benchmark")
    # the same in many blocks of test items and many shards
    small = decontaminate.contamination(docs, items, shard_words=20, block_bytes=80).drop("matches")
    same_as_sql(small, decontaminate.SQL, tmp_path, "documents", "benchmark")
    clean = decontaminate.drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert clean.count() == decontaminate.contamination(docs, items).filter("not contaminated").count()


def test_contamination_of_nothing(spark, tmp_path):
    docs, none = documents(spark), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).filter("contaminated").count() == 0
    assert decontaminate.contamination(documents(spark, []), bench(spark, tmp_path)).count() == 0


def test_longest_matches_and_places(spark, tmp_path):
    docs = documents(spark, [(1, "pre " + NOTE + " post", None, None)])
    (row,) = decontaminate.contamination(docs, bench(spark, tmp_path)).collect()
    found = {(m.item_id, m.item_word, m.doc_word, m.n_words) for m in row.matches}
    assert found == {("1", 0, 1, 12), ("3", 0, 1, 10)}


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 70))
@settings(max_examples=200, deadline=None)
def test_suffix_array(symbols, depth):
    order = decontaminate.suffix_array(np.array(symbols, np.int64), depth).tolist()
    assert sorted(order) == list(range(len(symbols)))
    heads = [symbols[i:i + depth] for i in order]
    assert heads == sorted(heads)
