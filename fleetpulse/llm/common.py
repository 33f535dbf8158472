"""Column expressions shared by the operators of this subpackage."""

import string

from pyspark.sql import Column, DataFrame, functions as F

# The white space of the word and line rules, [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"


def whole_text(name: str = "text") -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lowered(text: Column) -> Column:
    """``A-Z`` in lower case; all other letters stay."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text: runs without white space."""
    spaced = F.translate(text, WHITE, " " * len(WHITE))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def documents_of(docs: DataFrame) -> DataFrame:
    """``doc`` (the whole row), ``id``, ``text`` and ``fp``, a fingerprint of the text.

    Extra columns stay inside ``doc``, so none of their names can clash. (id, fp) is the
    key of a row: rows that share both are copies of each other and get equal results.
    """
    text = whole_text()
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("fp"),
    )


def hash_pair(key: Column) -> list[Column]:
    """Two independent 64-bit hashes, ``h1`` and ``h2``, that stand for ``key``."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")]


class Remembered(dict):
    """Answers of ``make``, of which the older half is forgotten beyond ``most`` entries.

    Keys of more than ``longest`` letters are answered, but not kept.
    """

    def __init__(self, make, most: int, longest: int = 64):
        super().__init__()
        self.make, self.half, self.longest, self.older = make, max(1, most // 2), longest, {}

    def __missing__(self, key: str):
        if len(key) > self.longest:
            return self.make(key)
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
