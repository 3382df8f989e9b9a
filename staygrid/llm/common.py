"""Helpers shared by the operators: tables, word rules, shared-folder tables, memo of pre-tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.session import shared_dir

#: White space of the word rule ``[^\x20\x09-\x0D]+`` as SQL / Java patterns and characters.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, null read as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` matches, without an array pass over the words."""
    # SQL's trim takes a literal set of characters
    bare = F.trim(text, F.lit(SPACE_CHARS))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, SPACE_CLASS + "+"))).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder as Parquet and read back: cuts lineage, survives
    lost executors, keeps column pruning."""
    spark = df.sparkSession
    path = f"{shared_dir(spark, name)}/table"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def crc_bucket(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


class Memo(dict):
    """``text piece -> value`` with a bound on entries; emptied when full, so memory stays flat."""

    def __init__(self, make, bound: int = 400_000):
        super().__init__()
        self.make, self.bound = make, bound

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.clear()
        value = self[key] = self.make(key)
        return value


def byte_chars() -> list[str]:
    """Printable character for each byte, by the byte-level BPE rule: printable Latin-1 bytes
    stand for themselves, the others take the code points from 256 on in byte order."""
    kept = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


BYTE_TABLE = {b: c for b, c in enumerate(byte_chars())}


def to_byte_chars(piece: str) -> str:
    if piece.isascii() and piece.isprintable():
        return piece.replace(" ", BYTE_TABLE[32])
    return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(BYTE_TABLE)


class PreTokens:
    """Matches of a byte-level pattern. Texts of Latin-1 characters whose letters, digits and spaces
    the standard library classifies alike go through its faster engine."""

    #: Latin-1 characters on which ``\\w``, ``\\d`` or ``\\s`` of the two engines differ.
    UNLIKE = "\x1c\x1d\x1e\x1f\xb2\xb3\xb9\xbc\xbd\xbe"

    def __init__(self, pattern: str):
        import regex

        self.any = regex.compile(pattern).findall
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
        self.latin = None if "\\p" in plain else re.compile(plain).findall

    def __call__(self, text: str) -> list[str]:
        if self.latin is None:
            return self.any(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any(text)
        return self.any(text) if any(c in text for c in self.UNLIKE) else self.latin(text)


WORDS = re.compile(r"[^\x20\x09-\x0D]+")
