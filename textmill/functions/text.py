"""Text cleaning and splitting expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

# The code points str.strip() removes.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
            0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)

# Fixed value: the pre-split pattern a vocabulary is trained with.
PRE_SPLIT = (
    r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}"
    r"| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
)

REPLACEMENT = "\ufffd"


def coalesce_text(c) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(""))


def text_or_null(df: DataFrame, name: str) -> Column:
    """The column as text; a column of any other type counts as missing text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name)
    return F.lit(None).cast("string")


def strip_ws(c) -> Column:
    """Strip Unicode whitespace at both ends (``trim`` alone strips only U+0020)."""
    return F.btrim(c, F.lit(WHITESPACE))


def drop_invalid_utf8(c) -> Column:
    """Remove byte sequences that are not UTF-8, keeping everything else.

    ``make_valid_utf8`` writes U+FFFD for each of them, so genuine U+FFFD characters are escaped
    first (U+0001 is the escape mark) and restored afterwards. All of it runs inside the JVM.
    """
    c = c if isinstance(c, Column) else F.col(c)
    mark, escaped_mark, escaped_fffd = F.lit("\x01"), F.lit("\x01a"), F.lit("\x01b")
    fffd, nothing = F.lit(REPLACEMENT), F.lit("")
    kept = F.replace(F.replace(c, mark, escaped_mark), fffd, escaped_fffd)
    kept = F.replace(F.make_valid_utf8(kept), fffd, nothing)
    kept = F.replace(F.replace(kept, escaped_fffd, fffd), escaped_mark, mark)
    return F.when(F.is_valid_utf8(c), c).otherwise(kept)


def strip_surrogates(c) -> Column:
    """Remove lone surrogates. Text that is valid UTF-8 holds none."""
    return F.regexp_replace(c, r"[\x{D800}-\x{DFFF}]", "")


def is_ascii(c) -> Column:
    return F.octet_length(c) == F.char_length(c)


#: Texts that are Python strings at the same time.
NFKC_ROWS = 64


def _nfkc_slice(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _nfkc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """An Arrow batch goes through Python ``NFKC_ROWS`` texts at a time; a string may take four times the
    bytes of its text, a batch of them several times those of the Arrow batch."""
    for batch in batches:
        parts = [_nfkc_slice(batch.slice(i, NFKC_ROWS)) for i in range(0, len(batch), NFKC_ROWS)]
        yield pa.concat_arrays(parts) if parts else pa.array([], pa.string())


#: Shortest run of stable code points that the quick check names; shorter ones cost more than they spare.
STABLE_RUN = 48


@cache
def stable_runs() -> list[tuple[int, int]]:
    """Runs of code points that no neighbour can change: any text of them is its own NFKC form.

    Such a character is its own form, has no combining class and is never the second of two that
    compose: it does not stand second in a canonical decomposition and is no Hangul vowel or final.
    """
    points = [p for p in range(sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF]
    seconds = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for p in points:
        parts = unicodedata.decomposition(chr(p)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(int(parts[1], 16))
    runs: list[tuple[int, int]] = []
    for p in points:
        c = chr(p)
        if p in seconds or unicodedata.combining(c) or not unicodedata.is_normalized("NFKC", c):
            continue
        if runs and runs[-1][1] == p - 1:
            runs[-1] = runs[-1][0], p
        else:
            runs.append((p, p))
    return [(a, b) for a, b in runs if b - a >= STABLE_RUN - 1]


def may_change(c: Column) -> Column:
    """Whether a text holds a character outside the stable runs."""
    outside = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in stable_runs())
    return c.rlike(f"[^{outside}]")


def nfkc(c) -> Column:
    """Unicode NFKC. Only rows with a character that may change carry text to Python."""
    c = c if isinstance(c, Column) else F.col(c)
    return F.coalesce(_nfkc(F.when(~is_ascii(c) & may_change(c), c)), c)


def pre_split(c) -> Column:
    """Split into pieces; every character lands in exactly one piece.

    ``(?U)`` makes Java's ``\\s`` cover Unicode whitespace.
    """
    return F.regexp_extract_all(c, F.lit("(?U)" + PRE_SPLIT), F.lit(0))


#: Texts whose code points lie below are split by ``re``, which is faster but has no Unicode classes.
LATIN_END = 0x250
_BEYOND_LATIN = re.compile(f"[^\x00-{chr(LATIN_END - 1)}]")


def is_latin(c: Column) -> Column:
    """Whether every code point of a text lies below ``LATIN_END``."""
    return ~c.rlike(rf"[^\x{{0}}-\x{{{LATIN_END - 1:X}}}]")


@cache
def _latin_pattern() -> re.Pattern:
    """``PRE_SPLIT`` with its classes written out below ``LATIN_END``."""

    def members(name: str) -> str:
        own = regex.compile(name)
        return "".join(f"\\u{p:04x}" for p in range(LATIN_END) if own.match(chr(p)))

    letter, number, space = (members(name) for name in (r"\p{L}", r"\p{N}", r"\s"))
    pattern = PRE_SPLIT.replace(r"[^\r\n\p{L}\p{N}]", f"[^\\r\\n{letter}{number}]")
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]")
    for name, own in ((r"\p{L}", letter), (r"\p{N}", number), (r"\s", space)):
        pattern = pattern.replace(name, f"[{own}]")
    return re.compile(pattern.replace(r"\S", f"[^{space}]"))


def python_split() -> Callable[[str], list[str]]:
    """The pieces of one text, as :func:`pre_split`, for use inside a task."""
    latin, other = _latin_pattern().findall, regex.compile(PRE_SPLIT).findall

    def split(text: str) -> list[str]:
        return latin(text) if text.isascii() or not _BEYOND_LATIN.search(text) else other(text)

    return split


def byte_text(c) -> Column:
    """One character U+0000..U+00FF per UTF-8 byte."""
    return F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")


#: Bytes of the texts whose byte lists are made at once, or one text.
BYTES_AT_ONCE = 4_000_000


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _byte_lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        lists = batch.cast(pa.binary())
        _, ends, data = lists.buffers()
        places = np.frombuffer(ends, np.int32)[lists.offset : lists.offset + len(lists) + 1]
        at = 0
        while at < len(lists):  # ids are four times as long as texts, so a batch goes on in parts
            own = slice(at, max(int(np.searchsorted(places, places[at] + BYTES_AT_ONCE, side="right")) - 1, at + 1))
            cuts = places[own.start : own.stop + 1]
            held = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if data is not None else np.zeros(0, np.uint8)
            mask = lists[own].is_null() if lists.null_count else None
            yield pa.ListArray.from_arrays(pa.array(cuts - cuts[0]), pa.array(held.astype(np.int32)), mask=mask)
            at = own.stop
        if not len(lists):
            yield pa.array([], pa.list_(pa.int32()))


def to_bytes(c) -> Column:
    """The UTF-8 bytes as ``ARRAY<INT>``: an Arrow column of texts is one of bytes already."""
    return _byte_lists(F.encode(c, "UTF-8"))


def token_class(text: Column, special: Column) -> Column:
    """``special``, ``word`` or ``non_word`` by the first character of the decoded token."""
    return (
        F.when(special, F.lit("special"))
        .when(text.rlike(r"^[\p{L}\p{N}_]"), F.lit("word"))
        .otherwise(F.lit("non_word"))
    )
