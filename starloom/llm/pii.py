"""Personal data by a skip-chain conditional random field.

Base spans (emails, IPv4 addresses, payment cards, phone numbers) are found by
pattern.  The field runs over a document's units in text order: the base spans
and, between them, other candidates (runs of at least ``LEAST_DIGITS`` digits
with separators, tokens with an at sign).  Its labels are the four kinds and
"none".  Potentials:

* node: log P(label | shape of the unit); a base span holds its own label;
* chain: log-odds of the labels of neighbouring units, half from each side;
* skip: of units, however far apart, that repeat each other (same digits, or
  same last ``TAIL`` digits, or the same address apart from case), and of
  candidates similar to a base span (as many digits, at least ``TAIL``, and all but
  one the same).  Repeats are linked as stars: to the first base span with the same
  key, or else to the first unit.  So links grow with the units, not with their pairs.

Training is piecewise, on counts over all documents, with the base spans as
labels and no weight set by hand.  That no pattern matches a candidate says
nothing of whether it repeats a span's data, so a candidate linked to a base span
counts for that span's kind, and any other as "none".  What a link is worth is
found with decoys: each base span is also given a number that nobody wrote (its last
two digits turned), and the links of candidates to decoys are those that chance
brings, for instance among consecutive numbers.  A skip potential is the log-odds of
links to spans over links to decoys: it is large where numbers only agree because
one repeats the other, and near 0 where anything agrees with anything.  Inference is
loopy belief propagation, all messages of a document at once.  A candidate whose
belief in a kind is over one half becomes a span of that kind.

Scale: two maps over the documents and one group-by of counts over a bounded
set of shapes (digit counts are bounded by ``MOST_DIGITS``).  Counts and decoys are
made within one document, so they don't depend on how documents are partitioned.

Defined cases: null counts as empty; a text without digits and at signs has no
unit; patterns take time linear in the text, also on one endless run of digits;
repeated rows get equal results; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LEAST_DIGITS, MOST_DIGITS, TAIL = 7, 24, 9
#: Most digits that a number of 64 bits always holds: longer numbers have no similar ones.
SIMILAR_DIGITS = 19
#: The least probability that unrelated numbers agree by chance: that of LEAST_DIGITS random digits.
CHANCE = 10.0 ** -LEAST_DIGITS
DECOY_TURN = 37
#: Log-odds that no sum of messages outweighs: a base span holds its label.
HELD = 1e4
ROUNDS, DAMPING = 16, 0.5

_HAS = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"\+?\(?[0-9][0-9 ().-]*[0-9]")
_AT = re.compile(r"(?<![^\s@])[^\s@]*+@[^\s@]*")
_DIGIT = re.compile(r"[0-9]")


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            yield start, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind), by start and kind."""
    if not _HAS.search(text):
        return []
    found = [(a, b, 0) for a, b in _emails(text)]
    found += [(m.start(), m.end(), 1) for m in _IP.finditer(text)
              if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split(".")))]
    for m in _CARD.finditer(text):
        d = digits_of(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), m.end(), 2))
    found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Units between the base spans, labelled "none"."""
    found: list[tuple[int, int, int]] = []
    edges, upto = [], 0
    for start, end, _ in sorted(base):
        edges.append((upto, start))
        upto = max(upto, end)
    edges.append((upto, len(text)))
    for lo, hi in edges:
        if hi - lo < LEAST_DIGITS:
            continue
        taken = []
        for m in _AT.finditer(text, lo, hi):
            if len(m[0]) > 2:
                taken.append((m.start(), m.end(), NONE))
        found += taken
        k = 0
        for m in _NUMBER.finditer(text, lo, hi):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if (k == len(taken) or taken[k][0] >= m.end()) and len(digits_of(m[0])) >= LEAST_DIGITS:
                found.append((m.start(), m.end(), NONE))
    return found


def shape(unit: str) -> str:
    """What a node's potential sees of a unit; a bounded set of strings."""
    d = digits_of(unit)
    n = min(len(d), MOST_DIGITS)
    marks = "".join(c for c in "+( .-@" if c in unit)
    if "@" in unit:
        return "@" + ("." if "." in unit.rpartition("@")[2] else "")
    dots = min(unit.count("."), 4)
    return f"{n}{marks}{dots}{'L' if 12 <= len(d) <= 19 and luhn(d) else ''}"


def key(unit: str) -> str:
    """Units with equal keys repeat each other."""
    if "@" in unit:
        return unit.lower().strip(".,;:!?()<>[]\"'")
    return digits_of(unit)[-TAIL:]


def units_of(text: str) -> list[tuple[int, int, int, str, str]]:
    """(start, end, label, shape, key) in text order."""
    base = base_spans(text)
    if not base and not _HAS.search(text):
        return []
    units = sorted(base + candidates(text, base), key=lambda s: (s[0], s[2]))
    return [(a, b, k, shape(text[a:b]), key(text[a:b])) for a, b, k in units]


def links(keys: list[str], labels: list[int] | None = None) -> list[tuple[int, int]]:
    """Each unit with the hub of its key: the first base span with it, else the first unit."""
    hub: dict[str, int] = {}
    for i, k in enumerate(keys):
        if k not in hub or labels is not None and labels[hub[k]] == NONE != labels[i]:
            hub[k] = i
    return [(min(hub[k], i), max(hub[k], i)) for i, k in enumerate(keys) if hub[k] != i]


def similar(spans: list[str], others: list[str]) -> dict[int, int]:
    """For numbers of ``others`` that differ from one of ``spans`` in exactly one digit:
    its place -> the place of the first such span.  All are digits only; numbers of other lengths
    than TAIL to SIMILAR_DIGITS have none.  One array of numbers without their digit at a place is
    held at a time."""
    found: dict[int, int] = {}
    lengths: dict[int, tuple[list[int], list[int]]] = {}
    for side, numbers in enumerate((spans, others)):
        for i, d in enumerate(numbers):
            if TAIL <= len(d) <= SIMILAR_DIGITS:
                lengths.setdefault(len(d), ([], []))[side].append(i)
    for length, (at, to) in lengths.items():
        if not at or not to:
            continue
        x = np.array([int(spans[i]) for i in at], np.uint64)
        y = np.array([int(others[i]) for i in to], np.uint64)
        for place in range(length):
            unit = np.uint64(10 ** place)
            x_digit, y_digit = x // unit % np.uint64(10), y // unit % np.uint64(10)
            x_rest, y_rest = x - x_digit * unit, y - y_digit * unit
            order = np.argsort(x_rest, kind="stable")
            rest = x_rest[order]
            lo, hi = np.searchsorted(rest, y_rest, "left"), np.searchsorted(rest, y_rest, "right")
            for k in np.flatnonzero(hi > lo):
                # spans equal to the number itself stand in this stretch too; their digit is the same
                first = next((int(j) for j in order[lo[k]:hi[k]] if x_digit[j] != y_digit[k]), None)
                if first is not None:
                    found[to[k]] = min(found.get(to[k], at[first]), at[first])
    return found


def decoy(digits: str) -> str:
    """A number that stands for no span: the last two digits turned."""
    return f"{digits[:-2]}{(int(digits[-2:]) + DECOY_TURN) % 100:02d}" if len(digits) >= LEAST_DIGITS else ""


class Linked:
    """The units of a text and their skip links."""

    def __init__(self, text: str, units: list[tuple[int, int, int, str, str]]):
        self.units = units
        self.labels = [u[2] for u in units]
        keys = [u[4] for u in units]
        self.repeats = links(keys, self.labels)
        at = [i for i, k in enumerate(self.labels) if k != NONE]
        self.to = [i for i, k in enumerate(self.labels) if k == NONE]
        self.similar: list[tuple[int, int]] = []
        self.spans: list[str] = []
        if at and self.to:
            held = {keys[i] for i in at}
            others = ["" if keys[i] in held or "@" in keys[i] else digits_of(text[units[i][0]:units[i][1]]) for i in self.to]
            self.spans = ["" if "@" in keys[i] else digits_of(text[units[i][0]:units[i][1]]) for i in at]
            self.others = others
            self.similar = sorted((at[i], self.to[j]) for j, i in similar(self.spans, others).items())

    def label_by_links(self) -> dict[int, int]:
        """Candidates that are linked to a base span, with its kind."""
        found = {}
        for a, b in self.similar:
            found[b] = self.labels[a]
        for a, b in self.repeats:
            if (self.labels[a] == NONE) != (self.labels[b] == NONE):
                a, b = (b, a) if self.labels[a] == NONE else (a, b)
                found[b] = self.labels[a]
        return found

    def decoys(self) -> tuple[int, int]:
        """Candidates that repeat and that are similar to a decoy."""
        if not self.spans:
            return 0, 0
        turned = [decoy(d) for d in self.spans]
        tails = {d[-TAIL:] for d in turned if d}
        taken = [bool(d) and d[-TAIL:] in tails for d in self.others]
        near = similar(turned, ["" if t else d for t, d in zip(taken, self.others)])
        return sum(taken), len(near)


def counts_of(text: str) -> Counter:
    """What one document adds to the counts of the potentials."""
    units = units_of(text)
    found: Counter = Counter()
    if not units:
        return found
    linked = Linked(text, units)
    by_links = linked.label_by_links()
    labels = linked.labels
    guess = [by_links.get(i, k) for i, k in enumerate(labels)]
    found.update((f"node {u[3]}", str(k)) for u, k in zip(units, guess))
    found.update((f"chain {a}", str(b)) for a, b in zip(guess, guess[1:]))
    found.update((f"skip {guess[a]}", str(guess[b])) for a, b in linked.repeats)
    found.update(("similar", str(labels[a])) for a, _ in linked.similar)
    # units that could repeat a span of a kind, or candidates each other
    for k, n in Counter(labels).items():
        found["open", str(k)] += n - 1 + (len(linked.to) if k != NONE else 0)
    repeat, near = linked.decoys()
    found["decoy", "tried"] += len(linked.to) if linked.spans else 0
    found["decoy", "repeat"] += repeat
    found["decoy", "similar"] += near
    return +found


def count_potentials(docs: DataFrame, text_col: str = "text") -> dict[tuple[str, str], int]:
    """Counts over all documents: of (shape, label), of the labels at both ends of chain and
    skip links, of links to base spans by kind, and of links to decoys."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(counts_of(text or ""))
        yield pa.RecordBatch.from_pylist([{"what": w, "label": k, "n": n} for (w, k), n in found.items()],
                                         pa.schema([("what", pa.string()), ("label", pa.string()), ("n", pa.int64())]))

    counts = docs.select(text_col).mapInArrow(count, "what string, label string, n long")
    return {(r.what, r.label): r.n for r in counts.groupBy("what", "label").agg(F.sum("n").alias("n")).collect()}


class Field:
    """The trained field."""

    def __init__(self, counts: dict[tuple[str, str], int]):
        n = NONE + 1
        self.nodes: dict[str, np.ndarray] = {}
        for (what, label), c in counts.items():
            if what.startswith("node "):
                self.nodes.setdefault(what[5:], np.zeros(n))[int(label)] += c
        #: Of a shape that was never seen: a candidate is nothing, unless its links say so.
        self.prior = np.array([0.1] * NONE + [1.0])
        for s, c in self.nodes.items():
            p = c + self.prior
            self.nodes[s] = np.log(p / p[NONE])

        def pairs(kind: str) -> np.ndarray:
            c = np.array([[counts.get((f"{kind} {a}", str(b)), 0) for b in range(n)] for a in range(n)], float)
            return c + c.T

        p = pairs("chain") + np.eye(n) + 1.0 / n
        p /= p.sum()
        self.chain = np.log(p / np.outer(p.sum(1), p.sum(0))) / 2

        tried = counts.get(("decoy", "tried"), 0)

        def worth(hits: float, chances: float, by_chance: str) -> float:
            rate = (hits + 0.5) / (max(hits, chances) + 1)
            return max(0.0, float(np.log(rate / max(CHANCE, counts.get(("decoy", by_chance), 0) / max(1, tried)))))

        repeats, opened = pairs("skip").diagonal() / 2, [counts.get(("open", str(k)), 0) for k in range(n)]
        self.skip = np.diag([worth(repeats[k], opened[k], "repeat") for k in range(n)])
        near = [counts.get(("similar", str(k)), 0) for k in range(NONE)]  # of candidates alone
        self.similar = np.diag([worth(near[k], opened[k], "similar") for k in range(NONE)] + [0.0])

    def beliefs(self, units: list[tuple[int, int, int, str, str]], text: str = "") -> np.ndarray:
        """P(label) of every unit, by loopy belief propagation in log space; links of
        similar numbers need the text."""
        n, k = len(units), NONE + 1
        linked = Linked(text, units)
        node = np.array([self.nodes.get(u[3], np.log(self.prior)) for u in units])
        held = np.array(linked.labels)
        base = held != NONE
        node[base] = -HELD
        node[base, held[base]] = 0.0
        pairs = [(i, i + 1) for i in range(n - 1)] + linked.repeats + linked.similar
        if not pairs:
            return _softmax(node)
        a = np.array([p for p, _ in pairs] + [q for _, q in pairs])
        b = np.array([q for _, q in pairs] + [p for p, _ in pairs])
        table = np.concatenate([np.repeat(t[None], m, 0) for t, m in (
            (self.chain, n - 1), (self.skip, len(linked.repeats)), (self.similar, len(linked.similar)))])
        # tables are symmetric, so a message back uses the same one
        table = np.concatenate([table, table])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        message = np.zeros((len(a), k))
        for _ in range(ROUNDS):
            total = node.copy()
            np.add.at(total, b, message)
            out = total[a] - message[back]
            out = _log_sum(out[:, :, None] + table)
            out -= out.max(1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * out
        total = node.copy()
        np.add.at(total, b, message)
        return _softmax(total)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        units = units_of(text)
        found = [(a, b, k) for a, b, k, _, _ in units if k != NONE]
        if len(found) < len(units):
            belief = self.beliefs(units, text)
            best = belief[:, :NONE].argmax(1)
            found += [(u[0], u[1], int(best[i])) for i, u in enumerate(units) if u[2] == NONE and belief[i, best[i]] > 0.5]
        return sorted(found, key=lambda s: (s[0], s[2]))


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1, keepdims=True)
    return np.log(np.exp(x - top).sum(1)) + top[:, 0]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


RESULT = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and the columns of ``RESULT``; the counts and
    the digest are of the base spans, ``spans`` also has those the field adds."""
    counts = count_potentials(docs)

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        field = Field(counts)
        kind = pa.struct([(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())])
        for texts in batches:
            out = []
            for text in texts.to_pylist():
                spans = field.spans(text or "")
                base = base_spans(text or "") if spans else []
                row = {f"n_{name}": sum(s[2] == k for s in base) for k, name in enumerate(KINDS)}
                out.append(row | {"base_sha256": hashlib.sha256(_written(base).encode()).hexdigest(), "spans": _written(spans)})
            yield pa.array(out, kind)

    found = F.arrow_udf(find, RESULT)(F.col("text"))
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")
