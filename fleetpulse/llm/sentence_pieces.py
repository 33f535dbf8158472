"""SentencePiece encoding and decoding for merge-type vocabularies, by an agenda of adjacent pairs."""

import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2

from fleetpulse.llm.common import Remembered, documents_of

# The mark that stands for a space, the replacement of a broken byte, and kinds in the model file.
SPACE, BROKEN = "▁", "�"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_TYPE = 2


class PieceModel:
    """A merge-type vocabulary with bytes for unknown letters, read from a model file.

    Other kinds of model raise a ValueError: their rules are not built.
    """

    def __init__(self, path: str):
        held = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            held.ParseFromString(f.read())
        rules, trained = held.normalizer_spec, held.trainer_spec
        kinds = {p.type for p in held.pieces}
        if trained.model_type != MERGE_TYPE or not trained.byte_fallback or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merge-type vocabularies of plain pieces with byte fallback can be encoded")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("only vocabularies that keep texts as they are can be encoded")
        self.leading_space = rules.add_dummy_prefix
        self.pieces = [p.piece for p in held.pieces]
        self.kinds = [p.type for p in held.pieces]
        normal = [(k, p) for k, p in enumerate(held.pieces) if p.type == NORMAL]
        self.ids = {p.piece: k for k, p in normal}
        self.scores = {p.piece: p.score for _, p in normal}
        self.byte_ids = {int(p[1:-1], 16): k for k, p in enumerate(self.pieces) if self.kinds[k] == BYTE}
        self.bytes = {k: b for b, k in self.byte_ids.items()}
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_text = trained.unk_surface
        self._find_borders()

    def _find_borders(self) -> None:
        """Which neighbouring letters stand next to each other inside some piece."""
        inside = {pair for piece in self.ids for pair in zip(piece, piece[1:], strict=False)}
        letters = sorted({c for pair in inside for c in pair})
        self.letter_class = np.zeros(0x110000, np.int32)
        self.letter_class[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.together = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for a, b in inside:
            self.together[self.letter_class[ord(a)], self.letter_class[ord(b)]] = True

    def marked(self, text: str) -> str:
        """The text as it is encoded: a space in front, all spaces as marks."""
        if not text:
            return ""
        return (SPACE if self.leading_space else "") + text.replace(" ", SPACE)

    def stretches(self, marked: str) -> list[str]:
        """The text cut wherever no piece holds both neighbours, so no merge can cross a cut."""
        points = np.frombuffer(marked.encode("utf-32-le"), "<u4")
        kinds = self.letter_class[points]
        cuts = (np.flatnonzero(~self.together[kinds[:-1], kinds[1:]]) + 1).tolist()
        return [marked[a:b] for a, b in zip([0, *cuts], [*cuts, len(marked)], strict=True)]

    def merged(self, stretch: str) -> list[str]:
        """The pieces of a stretch.

        The agenda holds every adjacent pair of symbols that is a piece, the best score first,
        then the leftmost. A pair is taken off and joined, unless one of its symbols has been
        joined since; the two pairs that the new symbol forms go onto the agenda.
        """
        score_of = self.scores.get
        symbols: list[str] = list(stretch)
        last = len(symbols) - 1
        left, right = list(range(-1, last)), list(range(1, last + 2))
        agenda = []
        for k in range(last):
            score = score_of(symbols[k] + symbols[k + 1])
            if score is not None:
                agenda.append((-score, k, k + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, a, b, size = heapq.heappop(agenda)
            joined = symbols[a] + symbols[b]
            if not symbols[a] or not symbols[b] or len(joined) != size:
                continue
            symbols[a], symbols[b] = joined, ""
            before, after = left[a], right[b]
            right[a] = after
            if after <= last:
                left[after] = a
                longer = joined + symbols[after]
                score = score_of(longer)
                if score is not None:
                    heapq.heappush(agenda, (-score, a, after, len(longer)))
            if before >= 0:
                longer = symbols[before] + joined
                score = score_of(longer)
                if score is not None:
                    heapq.heappush(agenda, (-score, before, a, len(longer)))
        return [s for s in symbols if s]

    def stretch_ids(self, stretch: str) -> list[int]:
        """Ids of a stretch; a letter without a piece becomes its bytes."""
        out = []
        for piece in self.merged(stretch):
            k = self.ids.get(piece)
            out += [k] if k is not None else [self.byte_ids[b] for b in piece.encode()]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids without begin and end."""
        marked = self.marked(text)
        return [k for s in self.stretches(marked) for k in self.stretch_ids(s)] if marked else []

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: control ids are silent, a broken byte becomes a mark of its own.

        One mark of a space that starts the text is dropped.
        """
        out: list[str] = []
        held = bytearray()
        first = True
        for k in ids:
            if self.kinds[k] == BYTE:
                held.append(self.bytes[k])
                continue
            if held:
                out.append(whole_letters(held))
                held, first = bytearray(), False
            if self.kinds[k] == CONTROL:
                continue
            if self.kinds[k] == UNKNOWN:
                out.append(self.unknown_text)
            else:
                piece = self.pieces[k]
                if first and self.leading_space and piece.startswith(SPACE):
                    piece = piece[1:]
                out.append(piece.replace(SPACE, " "))
            first = False
        if held:
            out.append(whole_letters(held))
        return "".join(out)

    def answer(self, stretch: str) -> tuple[bytes, str]:
        """Ids of a stretch as little-endian unsigned 32-bit integers, and their text inside a longer one."""
        ids = self.stretch_ids(stretch)
        if self.bytes.keys().isdisjoint(ids):
            text = "".join([self.pieces[k] for k in ids]).replace(SPACE, " ")
        else:
            text = self.decode([self.unknown, *ids])[len(self.unknown_text) :]
        return struct.pack(f"<{len(ids)}I", *ids), text


def whole_letters(held: bytes) -> str:
    """The letters of UTF-8 bytes; every byte that starts none becomes ``BROKEN``."""
    try:
        return held.decode()
    except UnicodeDecodeError:
        pass
    out, k = [], 0
    while k < len(held):
        lead = held[k]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            letter = bytes(held[k : k + size]).decode()
        except UnicodeDecodeError:
            letter, size = BROKEN, 1
        out.append(letter)
        k += size
    return "".join(out)


@lru_cache(maxsize=1)
def compiled_model(path: str, remembered: int) -> tuple[PieceModel, Remembered]:
    """What a worker reads once and uses for all its tasks: no result depends on it."""
    model = PieceModel(path)
    return model, Remembered(model.answer, remembered)


def _encoded(path: str, remembered: int, chars: int):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = compiled_model(path, remembered)
        begin, end = (struct.pack("<I", k) for k in (model.begin, model.end))

        def row(text: str) -> tuple[bytes, str]:
            marked = model.marked(text)
            if not marked:
                return begin + end, ""
            ids, texts = zip(*map(known.__getitem__, model.stretches(marked)), strict=True)
            decoded = "".join(texts)
            if model.leading_space and decoded.startswith(" "):
                decoded = decoded[1:]
            return b"".join([begin, *ids, end]), decoded

        for batch in stream:
            docs, texts = batch["doc"], batch["text"]
            start = held = 0
            ids, decoded = [], []
            for k in range(batch.num_rows):
                one = row(texts[k].as_py())
                ids.append(one[0])
                decoded.append(one[1])
                held += len(one[1])
                if held > chars or k == batch.num_rows - 1:
                    columns = [docs.slice(start, k + 1 - start), pa.array([len(x) // 4 for x in ids], pa.int64())]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names=["doc", "n_tokens", "ids", "decoded"]
                    )
                    start, held, ids, decoded = k + 1, 0, [], []

    return batches


def _kept(docs: DataFrame, columns: list[str] | None) -> DataFrame:
    documents = documents_of(docs)
    return documents.select(F.struct(*[F.col("doc")[c].alias(c) for c in columns or docs.columns]).alias("doc"), "text")


def encode_documents(
    docs: DataFrame, model_path: str, columns: list[str] | None = None, remembered: int = 1_000_000, chars: int = 1 << 22
) -> DataFrame:
    """``doc`` (the input row, or its ``columns``) with ``n_tokens``, ``ids`` and ``decoded`` of its whole text.

    ``ids`` are little-endian unsigned 32-bit integers with the begin and the end id;
    ``decoded`` is the text that these ids stand for. Both are those of the sentencepiece
    library with the same model (``differences`` compares them). A text is cut where no
    piece of the vocabulary holds both neighbours; each stretch is merged by an agenda of
    its adjacent pairs, and ``remembered`` answers of stretches up to 64 letters are kept
    by a worker. No shuffle; a task holds one text with its ids, or ``chars`` letters of
    short ones, at a time.

    Null and empty texts are the begin and the end id alone and decode to an empty text.
    Rows keep their number; repeated rows are encoded each; an empty table gives none.
    """
    kept = _kept(docs, columns)
    out = f"doc {kept.schema['doc'].dataType.simpleString()}, n_tokens long, ids binary, decoded string"
    return kept.mapInArrow(_encoded(model_path, remembered, chars), out)


def _compared(path: str):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in stream:
            same = []
            for k in range(batch.num_rows):
                ids = library.encode(batch["text"][k].as_py(), add_bos=True, add_eos=True)
                same.append(
                    np.array(ids, "<u4").tobytes() == batch["ids"][k].as_py() and library.decode(ids) == batch["decoded"][k].as_py()
                )
            yield pa.RecordBatch.from_arrays([batch["doc"], pa.array(same, pa.bool_())], names=["doc", "same"])

    return batches


def differences(docs: DataFrame, model_path: str) -> DataFrame:
    """The documents whose ids or decoded text are not the library's; whole texts, in Arrow batches.

    Has no row as long as the operator is right.
    """
    encoded = encode_documents(docs, model_path).select("doc", F.coalesce(F.col("doc.text"), F.lit("")).alias("text"), "ids", "decoded")
    out = f"doc {encoded.schema['doc'].dataType.simpleString()}, same boolean"
    return encoded.mapInArrow(_compared(model_path), out).where("not same").select("doc.*")
