"""Trained operators against plain enumeration: decoding, dual solution, marginals."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import common, langid, licenses, pii, quality
from tests.llm.helpers import documents

# language id


def plain_grams(text):
    """Buckets of byte n-grams, one by one."""
    letters = "".join(chr(b + 32) if 65 <= b <= 90 else chr(b) if 97 <= b <= 122 or b >= 128 else " " for b in text.encode())
    padded = (" " + " ".join(letters.split(" ")).strip() + " ").encode("latin-1")
    padded = b" " + b" ".join(padded.split()) + b" "
    found = []
    for n in langid.ORDERS:
        for s in range(len(padded) - n + 1):
            h = n
            for b in padded[s:s + n]:
                h = (h * 259 + b) % 2 ** 32
            found.append(h * 2654435761 % 2 ** 32 >> (32 - (langid.BUCKETS.bit_length() - 1)))
    return sorted(found)


@pytest.mark.parametrize("text", ["Hello, World", "a", "Äöü 12 straße", "  x\n\ny  "])
def test_grams_are_those_of_a_plain_walk(text):
    assert sorted(langid.grams(text).tolist()) == plain_grams(text)


def test_classifiers_are_those_of_plain_sums():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 5, (9, langid.BUCKETS)).astype(float)
    langs = [f"l{k}" for k in range(9)]
    model = langid.Model(langs, (counts[s:s + 4] for s in (0, 4, 8)))
    p = (counts + langid.SMOOTH) / (counts.sum(1, keepdims=True) + langid.SMOOTH * langid.BUCKETS)
    for b, ratio in enumerate(model.ratios):
        one = model.code[:, b] == 1
        assert np.allclose(ratio, np.log(p[one].mean(0) / p[~one].mean(0)))


def test_decoding_is_the_cheapest_of_all_codewords(spark):
    rnd = random.Random(2)
    alphabet = {"aa": "abcdef", "bb": "defghi", "cc": "uvwxyz", "dd": "aeiouy", "ee": "klmnop"}
    rows = [(i, " ".join("".join(rnd.choice(alphabet[lang]) for _ in range(5)) for _ in range(6)), lang, "s")
            for i, lang in enumerate(list(alphabet) * 24)] + [(900, "12 !", "aa", "s"), (901, None, None, None)]
    found = langid.predict(documents(spark, rows), F.col("doc_id") % 4 != 2).collect()
    marked = {r.doc_id: r for r in found}
    langs = sorted(alphabet)
    code = langid.codewords(len(langs)).astype(int)
    # how well each bit did on each language's training documents, counted plainly
    weight = []
    for k, lang in enumerate(langs):
        mine = [marked[i].margins for i, _, x, _ in rows if x == lang and i % 4 != 2 and marked[i].margins is not None]
        right = [max(1e-3, sum((m[b] > 0) == (code[k][b] > 0) for m in mine) / len(mine)) for b in range(code.shape[1])]
        weight.append([w / sum(right) for w in right])
    for i, text, _, _ in rows:
        r = marked[i]
        if r.margins is None:
            assert (r.lang_pred, r.score) == ("und", 0.0) and not langid.has_letter(text)
            continue
        cost = [sum(w * math.log1p(math.exp(-langid.SLOPE * c * m)) for w, c, m in zip(weight[k], code[k], r.margins))
                for k in range(len(langs))]
        order = sorted(range(len(langs)), key=lambda k: cost[k])
        assert r.lang_pred == langs[order[0]]
        share = 1 / sum(math.exp(-(c - cost[order[0]]) * code.shape[1]) for c in cost)
        assert abs(r.score - share) < 1e-6
        assert r.ambiguous == (cost[order[1]] < langid.AMBIGUOUS * cost[order[0]])


# quality

def objective(w, x, y, cost):
    return 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w))).sum()


@pytest.mark.parametrize("seed", range(4))
def test_dual_descent_reaches_the_optimum_of_a_dense_solver(seed):
    rng = np.random.default_rng(seed)
    n, size = 40, 12
    rows = [np.sort(rng.choice(size, rng.integers(1, 6), replace=False)) for _ in range(n)]
    values = [rng.normal(size=len(r)) for r in rows]
    y = np.where(rng.random(n) < 0.3, 1.0, -1.0)
    w = quality.dual_coordinate_descent(rows, values, y, size, rounds=3000)
    x = np.zeros((n, size + 1))
    for k, (r, v) in enumerate(zip(rows, values)):
        x[k, r], x[k, -1] = v, 1.0
    upper = quality.COST * np.array([n / 2 / max(1, (y == s).sum()) for s in y])
    # the dual by projected gradient over the whole matrix
    q = (x * y[:, None]) @ (x * y[:, None]).T
    alpha, step = np.zeros(n), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(60_000):
        alpha = np.clip(alpha + step * (1 - q @ alpha), 0, upper)
    best = (alpha * y) @ x
    assert objective(w, x, y, upper) <= objective(best, x, y, upper) * (1 + 1e-3) + 1e-9


# personal data

def test_beliefs_are_exact_marginals_where_links_make_no_loop():
    counts = {("node 70", "4"): 9, ("node 70", "3"): 6, ("node 80", "4"): 5, ("node 80", "2"): 7, ("node 90", "3"): 8, ("node 90", "4"): 8,
              ("chain 3", "3"): 30, ("chain 3", "4"): 4, ("chain 4", "4"): 9, ("skip 3", "3"): 20, ("skip 4", "4"): 20}
    field = pii.Field(counts)
    for text in ("a 1234567 b", "a 1234567 b 12345678 c", "a 1234567 b 12345678 c 123456789 d", "a 12345678 b 123456789 c +1 (555) 010-1234 d"):
        units = pii.units_of(text)
        assert not pii.links([u[4] for u in units])
        n, k = len(units), pii.NONE + 1
        node = [np.where(np.arange(k) == u[2], 0.0, -30.0) if u[2] != pii.NONE else field.nodes.get(u[3], np.log(field.prior)) for u in units]
        total = np.zeros((n, k))
        for labels in itertools.product(range(k), repeat=n):
            p = math.exp(sum(node[i][a] for i, a in enumerate(labels)) + sum(field.chain[a, b] for a, b in zip(labels, labels[1:])))
            for i, a in enumerate(labels):
                total[i, a] += p
        exact = total / total.sum(1, keepdims=True)
        assert np.allclose(field.beliefs(units), exact, atol=5e-3)


def test_distant_repeats_agree_in_the_field_as_in_its_best_labelling():
    """With a loop of chain and skip links the beliefs are approximate; their labels are those of the best whole labelling."""
    counts = {("node 11+( -0", "3"): 50, ("node 110", "4"): 50, ("node 70", "4"): 20, ("skip 3", "3"): 20, ("skip 4", "4"): 20}
    field = pii.Field(counts)
    text = "+1 (555) 010-1234 then 7654321 and 15550101234 and 7654321"
    units = pii.units_of(text)
    pairs = pii.links([u[4] for u in units])
    assert len(pairs) == 2
    k = pii.NONE + 1
    node = [np.where(np.arange(k) == u[2], 0.0, -30.0) if u[2] != pii.NONE else field.nodes.get(u[3], np.log(field.prior)) for u in units]
    best = max(itertools.product(range(k), repeat=len(units)), key=lambda x: sum(node[i][a] for i, a in enumerate(x)) + sum(
        field.chain[a, b] for a, b in zip(x, x[1:])) + sum(field.skip[x[i], x[j]] for i, j in pairs))
    assert field.beliefs(units).argmax(1).tolist() == list(best)


# licences

def plain_scan(index, text):
    """Base places and phrases by sliding over the text, labels by trying every alignment of every template."""
    starts, base = [], set()
    for phrase, label in licenses.BASE.items():
        w = [x.encode() for x in phrase.split()]
        found = [i for i in range(len(text) - len(w) + 1) if text[i:i + len(w)] == w]
        starts += found
        base |= {label} if found else set()
    labels = set(base)
    for t, (label, _, _) in enumerate(licenses.TEMPLATES):
        words_, anchors = index.texts[t], index.anchors[t]
        total = sum(anchors.values())
        for first in range(-len(words_), len(text)):
            for last in range(first, first + licenses.SLACK + 1):
                met = {q for q in anchors for d in range(first, last + 1) if 0 <= d + q < len(text) and text[d + q] == words_[q]}
                if sum(anchors[q] for q in met) >= licenses.SHARE * total - 1e-9:
                    stretch = text[max(0, first):last + len(words_) + licenses.SLACK]
                    if all(any(tuple(stretch[i:i + len(k)]) == k for i in range(len(stretch))) for k in index.keys[t]):
                        labels.add(label)
    return starts, base, labels


def test_licence_scan_against_all_alignments():
    common_words = [b"the", b"of", b"to", b"a", b"and", b"this", b"in", b"is", b"license", b"under"]
    index = licenses.Index(1000, dict.fromkeys(common_words, 500))
    rnd = random.Random(8)
    vocabulary = sorted(licenses.vocabulary()) + [b"lorem", b"ipsum"]
    planted = 0
    for case in range(60):
        label, notice, _ = licenses.TEMPLATES[case % len(licenses.TEMPLATES)]
        words_ = common.words(notice)
        if case % 3 == 1:  # a word more or less than SLACK allows
            words_ = words_[:len(words_) // 2] + [b"lorem"] * rnd.randint(1, 6) + words_[len(words_) // 2:]
        if case % 3 == 2:
            words_ = [w for w in words_ if rnd.random() > 0.25]
        text = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 12))] + words_ + [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 12))]
        if case % 5 == 0:
            text += common.words(rnd.choice(list(licenses.BASE)))
        got = index.scan(text)
        starts, base, labels = plain_scan(index, text)
        assert (got["n_base"], got["first_word"], got["last_word"]) == (len(starts), min(starts, default=None), max(starts, default=None))
        assert got["base_labels"] == ",".join(sorted(base)) and got["n_words"] == len(text)
        found = set(got["labels"].split(",")) - {""}
        assert found <= labels, "no label without an alignment that holds its mandatory phrases"
        if case % 3 == 0:
            planted += 1
            assert label in found and label in labels
    assert planted == 20
