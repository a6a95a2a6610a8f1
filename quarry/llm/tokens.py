"""Token counts by the library of a public tokenizer, in Arrow batches."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import quoted, text_of

BATCH_BYTES = 1 << 20  # text given to the library at once
MEMO = 1_000_000  # pieces whose count a task remembers
SPACE = "▁"  # how sentencepiece writes a space


class WholeTexts:
    """Counts of whole texts as the library gives them."""

    def __init__(self, encode):
        self.encode = encode

    def count(self, texts: list[str]) -> list[int]:
        out, part, size = [], [], 0
        for t in texts:
            part.append(t)
            size += len(t)
            if size >= BATCH_BYTES:
                out += self.encode(part)
                part, size = [], 0
        return out + (self.encode(part) if part else [])


class Pieces(WholeTexts):
    """Counts by pieces between which no token of the vocabulary reaches.

    Safe where no entry has a space after another character, or a line end at all, and where
    the normaliser leaves text alone: then a merge never crosses the place before a space
    or beside a line end, and counts of pieces add up to the count of the text. The library
    puts a space before each piece it is given, which stands for the space cut off, or, for a
    piece after a line end, costs the one token that is taken off again.
    """

    def __init__(self, encode):
        super().__init__(encode)
        self.memo: dict[str, int] = {"": 1}  # a space alone
        self.cut = re.compile(f"(?<=[^ {SPACE}]) ")

    @staticmethod
    def safe(vocabulary, normalize, encode) -> bool:
        probe = "a  b ééﬁ c\n d"
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in vocabulary):
            return False
        same = normalize(probe) == SPACE + probe.replace(" ", SPACE)
        lone = encode(["a", "a ", "\n", "\na", " \n", "a\na"])
        return same and lone == [1, 2, 2, 3, lone[4], 3] and SPACE in vocabulary

    def pieces(self, line: str) -> list[str]:
        if "  " in line or SPACE in line or line[:1] == " ":
            return self.cut.split(line)
        return line.split(" ")

    def count(self, texts: list[str]) -> list[int]:
        out = []
        part, size = [], 0
        for t in texts:
            part.append(t)
            size += len(t)
            if size >= 8 * BATCH_BYTES:
                out += self._count(part)
                part, size = [], 0
        return out + self._count(part)

    def _count(self, texts: list[str]) -> list[int]:
        cut, extra = [], []
        for t in texts:
            if not t:
                cut.append([])
                extra.append(0)
                continue
            first, *rest = t.split("\n")
            pieces = self.pieces(first)
            for line in rest:
                head, *tail = self.pieces(line)
                pieces.append("\n" + head)
                pieces += tail
            cut.append(pieces)
            extra.append(-len(rest))
        if len(self.memo) > MEMO:
            self.memo = {"": 1}
        new = [p for p in set().union(*cut) if p not in self.memo]
        for p, n in zip(new, super().count(new)):
            self.memo[p] = n
        get = self.memo.__getitem__
        return [sum(map(get, pieces)) + more for pieces, more in zip(cut, extra)]


def counter(path: str) -> WholeTexts:
    """The counter for a tokenizer file: sentencepiece for ``.model``, tokenizers for ``.json``.

    Without begin, end or added tokens, truncation or padding.
    """
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def encode(texts):
            return [len(x) for x in sp.encode(texts, num_threads=1)]

        vocabulary = {sp.id_to_piece(i) for i in range(sp.get_piece_size())}
        return (Pieces if Pieces.safe(vocabulary, sp.normalize, encode) else WholeTexts)(encode)
    if path.endswith(".json"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return WholeTexts(lambda texts: [len(e) for e in t.encode_batch(texts, add_special_tokens=False)])
    raise ValueError(f"no library for {path}")


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``; one row per row.

    ``path`` is the tokenizer file, the same on every executor. Tokens are those that the
    library gives for the whole text; long texts reach it in pieces cut where no token can
    cross (see :class:`Pieces`), a piece that recurs is counted once per task, and calls are
    filled by bytes. A tokenizer for which this does not hold gets whole texts.

    A null text is empty; an empty text has no tokens. Repeated rows and null ids count like
    any other. An empty table gives an empty table. The texts are read once, nothing is
    shuffled, only lengths leave the tasks.
    """
    rows = df.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("t"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"))
    schema = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in batches:
            n = np.array(c.count(b.column("t").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_bytes"), pa.array(n)], ["id", "n_bytes", "n_tokens"])

    out = rows.mapInArrow(lengths, schema)
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
