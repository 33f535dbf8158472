"""Substring dedup: repeated runs of consecutive sentences lose all but their first occurrence."""

import hashlib
import re
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fleetpulse.llm.common import documents_of

# A sentence ends with . ! ? or a line break and takes the terminators and white space that
# follow; the sentences of a text are the whole text.
SENTENCE = re.compile(rb"[^.!?\n]*[.!?\n][.!?\x20\x09-\x0D]*|[^.!?\n]+")


def sentences(text: str) -> list[bytes]:
    return SENTENCE.findall(text.encode())


# A word with the white space around it; the words of a sentence are the whole sentence.
WORD = re.compile(rb"\s*\S+\s*")
# A word in four ends a piece; without such a word, the sixteenth does.
PIECE_WORDS, MOST_WORDS = 4, 16


def pieces(text: str) -> list[bytes]:
    """Sentences cut after words that a hash of the word and the one before picks.

    The cuts depend on the words next to them, so a repeated passage has equal pieces from
    its first cut to its last one, whatever surrounds it.
    """
    out = []
    for sentence in sentences(text):
        begin = held = before = 0
        for m in WORD.finditer(sentence):
            word = crc32(m.group().strip().lower())
            held += 1
            if crc32(word.to_bytes(4, "little"), before) % PIECE_WORDS == 0 or held == MOST_WORDS:
                out.append(sentence[begin : m.end()])
                begin, held = m.end(), 0
            before = word
        if begin < len(sentence):
            out.append(sentence[begin:])
    return out


def runs(parts: list[bytes], span: int, min_words: int, to_ends: bool = False) -> Iterator[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, normalized words) of the run from each sentence.

    A run is the fewest sentences, at least ``span``, that hold ``min_words`` words
    together. Words count in lower case (A-Z) and without the white space between them.
    ``to_ends`` adds the shortest run that ends with each sentence, so that some run reaches
    the last whole sentence of any repeat that has a run.
    """
    words = [p.lower().split() for p in parts]
    keys = [b" ".join(w) for w in words]
    end = held = 0
    for start in range(len(parts)):
        while end < len(parts) and (end - start < span or held < min_words):
            held += len(words[end])
            end += 1
        if end - start < span or held < min_words:
            return
        yield start, end - start, b"\n".join(keys[start:end])
        held -= len(words[start])
        further, more = end, held
        while to_ends and further < len(parts) and (further - start - 1 < span or more < min_words):
            more += len(words[further])
            further += 1
            if further - start - 1 < span or more < min_words:
                yield start, further - start, b"\n".join(keys[start:further])


_RUNS = "id long, fp long, pos int, n int, h1 long, h2 long, sure boolean"


def _hashed_runs(span: int, min_words: int, cut: Callable[[str], list[bytes]]):
    to_ends = cut is not sentences

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rows = sorted(
                zip(batch["id"].to_pylist(), batch["fp"].to_pylist(), batch["text"], strict=True),
                key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
            )
            seen: set[bytes] = set()
            out: list[tuple] = []
            last = None
            for key, fp, text in rows:
                if (key, fp) == last:
                    continue
                last = (key, fp)
                reach = None
                for pos, n, run in runs(cut(text.as_py()), span, min_words, to_ends):
                    digest = hashlib.md5(run, usedforsecurity=False).digest()
                    if digest not in seen:
                        seen.add(digest)
                        h1, h2 = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
                        out.append((key, fp, pos, n, h1, h2, False))
                    elif reach is not None and pos <= reach[0] + reach[1]:
                        reach[1] = max(reach[1], pos + n - reach[0])
                    else:
                        if reach:
                            out.append((key, fp, *reach, fp, pos, True))
                        reach = [pos, n]
                if reach:
                    out.append((key, fp, *reach, fp, reach[0], True))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW.types, strict=True)], schema=_ARROW
                )

    return batches


_ARROW = pa.schema(
    [("id", pa.int64()), ("fp", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("sure", pa.bool_())]
)


def repeated_spans(documents: DataFrame, span: int, min_words: int, cut: Callable[[str], list[bytes]] = sentences) -> DataFrame:
    """Per document: (id, fp, spans), the runs that occur earlier, by (doc_id, position).

    A run that repeats within a batch is known to be no first occurrence there and then
    and joins its neighbours in one span, so of a run that fills a third of the corpus
    only one row per batch meets in the global sort.
    """
    found = documents.select("id", "fp", "text").mapInArrow(_hashed_runs(span, min_words, cut), _RUNS)
    order = W.partitionBy("h1", "h2").orderBy("sure", "id", "pos", "fp")
    head = F.struct("id", "fp", "pos")
    later = found.withColumn("first", F.first(head).over(order)).where(~head.eqNullSafe(F.col("first")) | F.col("sure"))
    return later.groupBy("id", "fp").agg(F.collect_list(F.struct("pos", "n")).alias("spans"))


def _apply(cut: Callable[[str], list[bytes]]):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out: tuple[list, ...] = ([], [], [], [], [])
            for k in range(batch.num_rows):
                text, spans = batch["text"][k].as_py(), batch["spans"][k].as_py() or []
                parts = cut(text)
                gone = bytearray(len(parts))
                for s in spans:
                    gone[s["pos"] : s["pos"] + s["n"]] = b"\1" * s["n"]
                starts = [0]
                for p in parts:
                    starts.append(starts[-1] + len(p))
                merged = [m.span() for m in re.finditer(b"\1+", gone)]
                kept = b"".join(p for p, g in zip(parts, gone, strict=True) if not g)
                row = (len(parts), sum(gone), len(merged), [{"start": starts[a], "end": starts[b]} for a, b in merged], kept.decode())
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            extra = [pa.array(c, t) for c, t in zip(out, _EXTRA.types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc"], *extra], names=["doc", *_EXTRA.names])

    return batches


_EXTRA = pa.schema(
    [("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
    + [("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())]
)


def dedup_substrings(docs: DataFrame, span: int = 2, min_words: int = 20, cut: Callable[[str], list[bytes]] = sentences) -> DataFrame:
    """Remove the sentences that a repeated run covers, except in the run's first occurrence.

    Runs are taken from the input, not from what is left, at every sentence; see ``runs``.
    The first occurrence is the one with the smallest (doc_id, position), null ids first.
    Returns (doc, n_sentences, n_removed, n_spans, spans, kept_text), one row per input
    row; ``doc`` is the input row, ``spans`` the removed byte ranges of its UTF-8 text.

    With ``cut=pieces`` the pieces of sentences take the place of sentences, and runs reach
    the last whole piece of a repeat: passages that lie inside one sentence, or that their
    surroundings glue onto, go as well, but for the words before their first cut and after
    their last one.

    A null or empty text has no sentence and stays empty; a text with under ``span``
    sentences or ``min_words`` words stays whole. Repeated rows (same id and text) are one
    document and get equal results; an empty table gives an empty table.
    """
    documents = documents_of(docs)
    spans = repeated_spans(documents, span, min_words, cut).withColumnsRenamed({"id": "s_id", "fp": "s_fp"})
    same = F.col("id").eqNullSafe(F.col("s_id")) & (F.col("fp") == F.col("s_fp"))
    joined = documents.join(spans, same, "left").select("doc", "text", "spans")
    kind = joined.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, n_sentences long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept_text string"
    return joined.mapInArrow(_apply(cut), schema)
