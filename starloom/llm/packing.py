"""Best-fit packing of tokenised documents by minimum bin slack.

Tokens.  A document is its tokens and one end token.  Texts whose code points
are all below U+0100 go through a table of pre-tokens that a worker has seen (the
model merges nothing across pre-tokens; the table is bounded, and when full keeps
what the present batch has too); other texts, and texts that hold a special token's string, go
through the library whole.  Only documents beyond the room of a sequence are
cut, into full pieces and one rest.

Packing.  Only the lengths matter, and there are at most ``room`` of them, so
the histogram of lengths is all that is packed: a bounded table at any size of
the corpus.  Minimum bin slack fills one sequence at a time.  It takes the
longest piece left, and a dynamic program over the lengths left finds all sums
that they can add to it: a bit set (one Python integer) whose bit s says that s
is reached, a length with c copies being shifted in by 1, 2, 4, ... copies.  The
highest sum is the fullest feasible combination; longer pieces are preferred on
the way back.  The combination is removed, as often as the histogram holds it
whole.  Each removal leaves one of its lengths fewer copies than the combination
has, so there are at most about ``room`` * log(room) of them.

Placing.  Pieces are numbered within their length by range partitions (a length
that a third of all pieces have is dealt over many tasks), and the number of a
piece says which copy of which combination it fills, at which place.

Defined cases: null text counts as empty; an empty document is its end token
alone; a null id stays null; repeated rows are documents of their own; ties
between equal lengths go by id; an empty table gives no rows; other columns are
not read; texts may have any length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import row_number_global
from .common import bounded_batches, materialize

TOKENIZER = "word_bpe_49k.json"
ROOM = 4096
END = 1
#: Pre-tokens that a Python worker keeps.
TABLE_TOKENS = 600_000
#: New pre-tokens that the library gets in one text.
WORDS_AT_ONCE = 2000
_WORD_END = "</w>"

# The tokenizer's split for lower-case texts below U+0100: contractions, letters,
# one digit or fraction, runs of anything else but white space.
_LETTER = "a-zªµºß-öø-ÿ"
_NUMBER = "0-9²³¹¼½¾"
_SPACE = "\t-\r \x85\xa0"
_PRETOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Tokens:
    """Ids of texts, special strings handled as the library's default does."""

    def __init__(self, path: str, table_tokens: int = TABLE_TOKENS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.table, self.most = Tokenizer.from_file(path), {}, table_tokens
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.ends = np.zeros(self.model.get_vocab_size(), bool)  # ids that end a pre-token
        self.ends[[i for t, i in self.model.get_vocab(with_added_tokens=False).items() if t.endswith(_WORD_END)]] = True
        probe = "It's they'LL we'Ve \t12½ A--b\r\nÀÉÖ×÷ßÿ ª!µ\x85\xa0\x1cx'"
        if self._by_pretokens([probe])[0].tolist() != self.library([probe])[0].tolist():
            raise ValueError(f"{path} doesn't split as this table of pre-tokens does")

    def library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of pre-tokens, many in one text: each ends with an end-of-word id."""
        for s in range(0, len(words), WORDS_AT_ONCE):
            part = words[s:s + WORDS_AT_ONCE]
            ids = self.library([" ".join(part)])[0]
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):
                raise ValueError("pre-tokens don't end with end-of-word ids")
            data, places = ids.tobytes(), (cuts * 4).tolist()
            yield from (data[a:b] for a, b in zip([0, *places], places))

    def _by_pretokens(self, texts: list[str]) -> list[np.ndarray]:
        table, split = self.table, [_PRETOKEN.findall(t.lower()) for t in texts]
        seen = set().union(*split)
        new = list(seen.difference(table))
        if len(table) + len(new) > self.most:  # what this batch has too is likely frequent: that stays
            kept = {w: table[w] for w in seen.difference(new)}
            table.clear()
            table.update(kept)
        table.update(zip(new, self._of_words(new)))
        found = [np.frombuffer(b"".join(map(table.__getitem__, words)), np.uint32) for words in split]
        if len(table) > self.most:  # one batch alone
            table.clear()
        return found

    def of(self, texts: list[str]) -> list[np.ndarray]:
        whole = [not _narrow(t) or any(s in t for s in self.special) for t in texts]
        ids = [iter(f([t for t, w in zip(texts, whole) if w is k])) for f, k in ((self._by_pretokens, False), (self.library, True))]
        return [next(ids[w]) for w in whole]


def _narrow(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


@lru_cache(maxsize=1)
def worker_tokens(path: str) -> Tokens:
    """One table per Python worker: Spark gives a worker many tasks in turn."""
    return Tokens(path)


def pieces(docs: DataFrame, path: str | None = None, room: int = ROOM, end: int = END, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and on demand ids."""
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(path or tokenizer_path())
        for batch in batches:
            columns = row, piece, start, length, digest, data = [], [], [], [], [], []
            for i, ids in enumerate(tokens.of([t or "" for t in batch.column(1).to_pylist()])):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                for k, s in enumerate(range(0, len(ids), room)):
                    part = ids[s:s + room].tobytes()
                    for column, value in zip(columns, (i, k, s, len(part) // 4, zlib.crc32(part), part if with_ids else None)):
                        column.append(value)
            arrays = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(length, pa.int64()), pa.array(digest, pa.int64()), pa.array(data, pa.binary())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:6 if with_ids else 5]
            yield pa.RecordBatch.from_arrays(arrays[:len(names)], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))


# minimum bin slack

def _fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """The fullest combination with the longest piece left: length -> copies."""
    first = max(left)
    space = room - first
    mask = (1 << (space + 1)) - 1
    sums, steps = 1, []  # steps: (length, copies, sums before it)
    full = 1 << space
    for length in sorted(left, reverse=True):
        copies = min(left[length] - (length == first), space // length)
        take = 1
        while copies > 0 and not sums & full:
            take = min(take, copies)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & mask
            copies, take = copies - take, take * 2
    best = sums.bit_length() - 1
    chosen = {first: 1}
    for length, take, before in reversed(steps):
        # without this step if the sum was reached before it: longer pieces come first
        if not before >> best & 1:
            chosen[length] = chosen.get(length, 0) + take
            best -= length * take
    return chosen


def patterns(histogram: dict[int, int], room: int = ROOM) -> list[tuple[dict[int, int], int]]:
    """Combinations (length -> copies) and how many sequences take each."""
    left, found = {n: c for n, c in histogram.items() if c}, []
    while left:
        chosen = _fullest(left, room)
        times = min(left[n] // k for n, k in chosen.items())
        found.append((chosen, times))
        for n, k in chosen.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return found


def places(found: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first number, copies in a sequence, first sequence, offset)
    of the pieces of that length, by first number."""
    rows: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for chosen, times in found:
        offset = 0
        for length, copies in sorted(chosen.items(), reverse=True):
            rows.setdefault(length, []).append((used.get(length, 0), copies, sequence, offset))
            used[length] = used.get(length, 0) + copies * times
            offset += length * copies
        sequence += times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def place(cut: DataFrame, room: int = ROOM) -> DataFrame:
    """Adds sequence_id and offset to pieces (rows of a written table)."""
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most ``room`` rows
    starts, total = {}, 0
    for length in sorted(counts):
        starts[length], total = total, total + counts[length]
    at = places(patterns(counts, room))
    order = ["length", "doc_id", "piece", "_row"]
    numbered = row_number_global(cut.withColumn("_row", F.monotonically_increasing_id()), order, "_number", offset=-1)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column("length").to_numpy(), batch.column("_number").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                number, rows = numbers[mine] - starts[int(length)], at[int(length)]
                row = rows[np.searchsorted(rows[:, 0], number, "right") - 1]
                copy, nth = np.divmod(number - row[:, 0], row[:, 1])
                sequence[mine], offset[mine] = row[:, 2] + copy, row[:, 3] + nth * length
            keep = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    names = cut.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return numbered.select(*names, "_number").mapInArrow(fill, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, room: int = ROOM, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and on demand ids (little-endian unsigned 32-bit)."""
    return place(materialize(pieces(docs, path, room, end, with_ids), "pieces"), room)
