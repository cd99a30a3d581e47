"""SentencePiece encoding and decoding by a table of distinct chunks.

No piece of the model holds a white-space mark after another character, so no
merge crosses from a word into the mark that follows it. A text is therefore cut
before each run of marks, every distinct marked chunk of a task is segmented
once, and ids, counts and decoded texts are joined back by position. The table
is bounded: it starts anew when it is full.

Cases: null and empty texts have the end id only and decode to an empty text;
runs of spaces, the mark itself in a text, and characters without a piece follow
the library. Every input row gives one output row, further columns stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from oreline.llm.common import require

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
CHARS_KEPT = 16 << 20  # of distinct chunks
CHARS_AT_ONCE = 1 << 20


def load(model_path: str) -> sentencepiece.SentencePieceProcessor:
    """The model, if its pieces allow cutting at marks."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    for i in range(model.get_piece_size()):
        if MARK in model.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} crosses a white-space mark")
    # A mark put before the text, and nothing else changed, is what cutting relies on.
    if model.normalize("  a  b ") != f"{MARK * 3}a{MARK * 2}b{MARK}":
        raise ValueError("the model changes white space")
    return model


def _piece_bytes(model: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
    """What a piece stands for in a decoded text."""
    if model.is_byte(i):
        return bytes([int(model.id_to_piece(i)[3:5], 16)])
    if model.is_control(i):
        return b""
    if model.is_unknown(i):
        return model.decode([i]).encode()
    return model.id_to_piece(i).replace(MARK, " ").encode()


class ChunkTable:
    """Ids (as text) of each distinct chunk, and its decoding where that is not the chunk."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor):
        self.model, self.end = model, model.eos_id()
        every = range(model.get_piece_size())
        self.parts = [_piece_bytes(model, i) for i in every]
        self.names = [f" {i}" for i in every]
        self.mark = model.piece_to_id(MARK)
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[str, str] = {}
        self.changed: dict[str, str] = {}
        self.chars = 0

    def segment(self, chunks: Iterable[str]) -> None:
        """Segment those that are not in the table."""
        new = list(set(chunks).difference(self.ids))
        self.chars += sum(map(len, new))
        # The library puts a mark before each text; the chunk's own first one is it.
        found = self.model.encode([c[1:] for c in new], num_threads=1) if new else []
        parts, names = self.parts, self.names
        for chunk, ids in zip(new, found):
            ids = ids or [self.mark]  # an empty text gets no mark
            self.ids[chunk] = "".join([names[i] for i in ids])
            decoded = b"".join([parts[i] for i in ids]).decode("utf-8", "replace")
            if decoded != chunk.replace(MARK, " "):
                self.changed[chunk] = decoded

    def encode(self, texts: list[str | None]) -> Iterator[tuple[str, int, str]]:
        """Decimal ids joined by spaces, their number, and the decoded text, of each."""
        if self.chars > CHARS_KEPT:
            self._clear()
        marked = [CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.segment(chain.from_iterable(marked))
        for chunks in marked:
            ids = "".join(map(self.ids.__getitem__, chunks))
            if self.changed:
                text = "".join([self.changed.get(c, c) for c in chunks])
            else:
                text = "".join(chunks)
            ids = f"{ids} {self.end}"
            yield ids[1:], ids.count(" "), text.replace(MARK, " ")[1:]


def _groups(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Neighbours of together about ``CHARS_AT_ONCE`` characters, or one longer text."""
    group, chars = [], 0
    for text in texts:
        group.append(text)
        chars += len(text or "")
        if chars >= CHARS_AT_ONCE:
            yield group
            group, chars = [], 0
    if group:
        yield group


def encode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (decimal, one space between), ``n_tokens``, ``decoded``.

    The end id is added, no begin id. Columns of those names are replaced.
    """
    return _mapped(docs, model_path, text, ["ids", "n_tokens", "decoded"], lambda ids, n, out: (ids, n, out))


def encode_digests(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """As ``encode``, with ``ids_sha256`` and ``decoded_sha256`` instead of the texts."""

    def digest(ids: str, n: int, decoded: str) -> tuple[str, int, str]:
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        return sha(ids), n, sha(decoded)

    return _mapped(docs, model_path, text, ["ids_sha256", "n_tokens", "decoded_sha256"], digest)


def _mapped(docs: DataFrame, model_path: str, text: str, names: list[str], finish) -> DataFrame:
    require(docs, text)
    docs = docs.drop(*[n for n in names if n != text])
    new = [StructField(n, LongType() if n == "n_tokens" else StringType()) for n in names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(model_path)
        table = ChunkTable(model)
        for batch in batches:
            rows = [finish(*r) for g in _groups(batch[text]) for r in table.encode(g)]
            yield batch.assign(**{n: [r[k] for r in rows] for k, n in enumerate(names)})

    return docs.mapInPandas(run, StructType([*docs.schema.fields, *new]))
