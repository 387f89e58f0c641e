"""Token counts of a sentencepiece model, one count per distinct pre-token.

A pre-token is a run of blanks with the word behind it, or the blanks that end
a text.  A model whose pieces never hold a blank after another character (it is
checked when the model is loaded) can't merge across the start of a pre-token,
so the tokens of a text are the sum over its pre-tokens.  Each task keeps the
pieces of the distinct pre-tokens that it has seen and joins them to every
document's pre-token frequencies; ids of documents are never made.

The table of distinct pre-tokens lives in the task, not in a shuffle: per
document frequencies are nearly as large as the texts, and a table of all
pre-tokens of the corpus grows with it, so neither moving the first nor
broadcasting the second holds at 100 TB.  The table is bounded by
``TABLE_TOKENS`` entries; when full it starts anew, which costs time only.

Defined cases: null and empty texts have no tokens; runs of blanks, line breaks,
control characters and strings that look like special tokens count as the
library's default counts them; repeated rows get equal counts; extra columns
are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
TABLE_TOKENS = 400_000
_PRETOKEN = re.compile(r" *[^ ]+| +")


def pretokens(text: str) -> list[str]:
    """Pre-tokens of a text, each without its first blank (every one has one:
    the model writes a blank as U+2581 and puts one in front of every text)."""
    text = text.replace("▁", " ")
    if text[0] == " " or text[-1] == " " or "  " in text:
        return [p[1:] for p in _PRETOKEN.findall(" " + text)]
    return text.split(" ")



#: A character that is a token of its own in front of any blank.
_HEAD = "x"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    """The model, checked to be separable at blanks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    blank = "▁"
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if blank in piece.lstrip(blank):
            raise ValueError(f"piece {i} of {path} spans a blank: counts don't add up over pre-tokens")
    probe = " \ta  b\r\nc 　 ▁d\u0000 "
    if len(model.encode(_HEAD + probe)) - len(model.encode(_HEAD)) != sum(
            len(model.encode(_HEAD + " " + p)) - len(model.encode(_HEAD)) for p in pretokens(_HEAD + probe)[1:]):
        raise ValueError(f"{path} changes white space: counts don't add up over pre-tokens")
    return model


class Counts:
    """Tokens of texts, through the table of distinct pre-tokens."""

    def __init__(self, path: str, table_tokens: int = TABLE_TOKENS):
        self.model, self.table, self.most = load(path), {}, table_tokens
        self.head = len(self.model.encode(_HEAD))

    def _pieces(self, new: list[str]) -> list[int]:
        ids = self.model.encode([f"{_HEAD} {p}" for p in new], num_threads=1)
        return [len(x) - self.head for x in ids]

    def of(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text of a batch."""
        freqs = [Counter(pretokens(t)) if t else {} for t in texts]
        table = self.table
        new = list(set().union(*freqs).difference(table))
        if len(table) + len(new) > self.most:
            table.clear()
            new = list(set().union(*freqs))
        pieces = dict(zip(new, self._pieces(new))) if new else {}
        table.update(pieces)
        counts = [sum(n * table[p] for p, n in f.items()) for f in freqs]
        if len(table) > self.most:  # one batch alone
            table.clear()
        return counts


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    bounded_batches(docs.sparkSession)

    def count_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = Counts(path or model_path())
        for texts in batches:
            yield pa.array(counts.of(texts.to_pylist()), pa.int64())

    n = F.arrow_udf(count_texts, T.LongType())(F.col("text"))
    counted = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                          n.alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
