"""SentencePiece encoding and decoding by a table of distinct chunks.

The model's pieces never hold a white space marker after another character, so
no merge crosses from a word into the marker of the next: a text's ids are the
ids of its chunks, a chunk being a run of markers with the word after it. Each
task keeps a table of the distinct chunks it has met; a chunk is segmented once
by the sentencepiece library, and texts become ids by looking up their chunks
in order of position. A vocabulary for which this does not hold is recognised,
and its texts are encoded whole.

One pass over whole texts, no shuffle. A table holds at most ``TABLE_CHUNKS``
chunks and starts anew when full; chunks longer than ``LONG_CHUNK`` characters
are not kept, so a task's memory is bounded whatever the texts are.

Cases: a null text is an empty one, which encodes to the begin and end ids;
rows are taken each for itself, repeated or not; a null id stays null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

MARK = "▁"
#: Markers (a space is one, once normalised), then a word up to the next marker.
_CHUNK = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")
TABLE_CHUNKS = 400_000
LONG_CHUNK = 64


class ChunkTable:
    """Texts to ids and back, by one model."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, list[int]] = {}
        pieces = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        plain = self.model.encode("a", out_type=str)[0].startswith(MARK) and self.model.encode("  a", out_type=str)[0] != MARK + "a"
        self.splits = plain and not any(MARK in p.lstrip(MARK) for p in pieces)

    def chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk, which begins with a marker that the model puts itself."""
        ids = self.ids.get(chunk)
        if ids is None:
            ids = self.model.encode(chunk[1:]) if len(chunk) > 1 else [self.model.piece_to_id(MARK)]
            if len(chunk) <= LONG_CHUNK:
                if len(self.ids) >= TABLE_CHUNKS:
                    self.ids.clear()
                self.ids[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """All ids of a text, begin and end ids included."""
        if not text or not self.splits:
            return self.model.encode(text, add_bos=True, add_eos=True)
        known, out = self.ids, [self.model.bos_id()]
        # The model puts a marker before the text; here it is written out.
        for chunk in _CHUNK.findall(" " + text):
            ids = known.get(chunk)
            out += self.chunk(chunk) if ids is None else ids
        out.append(self.model.eos_id())
        return out

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


def encode_decode(docs: DataFrame, model_path: str,
                  then: tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], str] | None = None) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) for every row of ``docs``.

    ``model_path`` is a SentencePiece model file of a few MB, readable by the
    driver; its bytes go to the tasks with the code. ``then``, a function of the
    resulting batches and the schema of what it yields, runs in the same task,
    for uses that need not carry all ids and texts through the JVM.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTable(model)
        for part in parts:
            for at in range(0, part.num_rows, 256):  # ids of few texts at a time
                some = part.slice(at, 256)
                ids = [chunks.encode(t or "") for t in some.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)])
                flat = pa.array(np.concatenate([np.array(x, np.int32) for x in ids]))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.record_batch([some.column(0), lists, pa.array(map(chunks.decode, ids), pa.string())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if then is None:
        return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
    return rows.mapInArrow(lambda parts: then[0](run(parts)), then[1])
