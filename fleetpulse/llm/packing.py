"""Packing: documents cut into power-of-two lengths, so no sequence crosses documents."""

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from fleetpulse.llm.common import Remembered, documents_of
from fleetpulse.llm.token_counts import Splitter, Vocabulary, byte_letters
from fleetpulse.session import settle

# Fixed value: the id that ends a document.
END_ID = 0


class Encoder:
    """The ids of the tokenizers library, piece by piece.

    The splitter cuts texts into the pieces that the library tokenizes apart, and the
    library's model, which does not split again, gives the ids of each distinct piece
    once. Special strings in a text become their own ids.
    """

    def __init__(self, path: str, remembered: int = 1_000_000):
        self.model = Tokenizer.from_file(path).model
        self.letters = {b: c for c, b in byte_letters().items()}
        special = Vocabulary(path).special_ids
        self.special = {text: struct.pack("<I", k) for text, k in special.items()}
        longest_first = sorted(special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None
        self.splitter = Splitter()
        self.known = Remembered(self.ids, remembered)

    def ids(self, piece: str) -> bytes:
        found = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(found)}I", *found)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts: list[str] = []
        shares = []
        for text in texts:
            own = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
            parts += own[::2]
            shares.append(own[1::2])
        pieces, counts = self.splitter.pieces(parts)
        ids = list(map(self.known.__getitem__, pieces))
        ends = np.cumsum(counts).tolist()
        out, part, start = [], 0, 0
        for between in shares:
            held = []
            for special in [*between, None]:
                held += ids[start : ends[part]]
                start = ends[part]
                part += 1
                if special is not None:
                    held.append(self.special[special])
            out.append(b"".join(held))
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """What a worker reads once and uses for all its tasks: no result depends on it."""
    return Encoder(path)


def binary_lengths(n: int, longest: int) -> list[int]:
    """``n`` as a sum of powers of two up to ``longest``, the largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length(), -1, -1) if rest >> k & 1]


def _pieces(path: str, longest: int):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path)
        for batch in stream:
            rows, held = [], 0
            for k in range(batch.num_rows):
                rows.append((batch["id"][k].as_py(), batch["text"][k].as_py()))
                held += len(rows[-1][1])
                if held > 1 << 20 or k == batch.num_rows - 1:
                    out: list[tuple] = []
                    for (doc_id, _), ids in zip(rows, tokenizer.encode([t for _, t in rows]), strict=True):
                        ids += struct.pack("<I", END_ID)
                        size, start = len(ids) // 4, 0
                        for length in binary_lengths(size, longest):
                            out.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], size))
                            start += length
                    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECE.types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=_PIECE)
                    rows, held = [], 0

    return batches


_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])


def binary_pieces(docs: DataFrame, vocabulary_path: str, longest: int = 1024) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens): each document's tokens cut at powers of two.

    ``ids`` are little-endian unsigned 32-bit token ids; every document ends with
    ``END_ID``, so null and empty texts are one piece of one id. ``longest`` must be a power
    of two. Repeated rows are documents of their own; an empty table gives no piece. No shuffle.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"longest must be a power of two, not {longest}")
    documents = documents_of(docs)
    return documents.select(F.col("id").cast("long").alias("id"), "text").mapInArrow(
        _pieces(vocabulary_path, longest), "doc_id long, start long, length long, ids binary, doc_tokens long"
    )


def bucketed(pieces: DataFrame) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: every piece is a sequence, equal lengths side by side.

    A range shuffle by (length, doc_id, start) puts pieces of one length into neighbouring
    partitions of even size, however many pieces have that length. A sequence is as long
    as its one piece, a power of two, so there is no padding. ``pieces`` is read twice, for
    the bounds of the ranges and for the rows.
    """
    order = ["length", "doc_id", "start"]
    ranged = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def packed_digests(docs: DataFrame, vocabulary_path: str, longest: int = 1024) -> DataFrame:
    """The packing plan: all sequences with a checksum of their ids instead of the ids."""
    pieces = binary_pieces(docs, vocabulary_path, longest)
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return bucketed(settle(digests, "pieces"))
