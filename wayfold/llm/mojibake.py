"""Text garbled by a wrong character encoding: finding it and restoring it where possible.

Round-trip repair. A stretch of suspicious text is encoded with each encoding it may have been read
by mistake (Latin-1, Windows-1252, Mac Roman, the Korean, Chinese and Japanese code pages, UTF-16
of the other byte order) and strictly decoded with each it may have been written in (UTF-8, the
Korean code page). A result counts if its garbling cost is lower than before and it reads as plain
text; layers are undone until no candidate lowers the cost. Stretches are runs of unusual
characters, words, and the whole value, so values garbled in part are found too. Replacement
characters, runs of question marks, C1 controls and private-use characters prove a loss that cannot
be undone; such values are reported without restored text.

Only values with a character outside printable ASCII and Hangul syllables, or with "??", leave the
JVM, in Arrow batches; no shuffle.

A value that was cut within its last character is restored without that character.

Defined results: null, empty and blank values are no case; decomposed Hangul, foreign letters,
Chinese characters, kana and symbols that were meant are no case; a repeated row gives a repeated
finding, and callers drop duplicates by key; very long values are handled whole; columns other
than the named ones are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUSPECT = r"[^ -~가-힣]|\?\?"
LOST = re.compile("�|\\?\\?|[\u0080-\u009f]|[-]")
RUN = re.compile(r"[^\x00-\x7f가-힣]+")
WORD = re.compile(r"\S+")
JAMO = re.compile("[\u1100-\u11ff]+")
#: fixed values: symbols and marks of ordinary Korean text
USUAL = set("·ㆍ–—~～※☆★○●◎□■△▲▽▼→←↑↓「」『』《》〈〉‘’“”…㈜㈔℃㎡½①②③④⑤⑥⑦⑧⑨⑩　 ​")


def _windows_1252() -> dict[str, int]:
    table = {}
    for i in range(256):
        try:
            table[bytes([i]).decode("cp1252")] = i
        except UnicodeDecodeError:
            table[chr(i)] = i
    return table


_W1252 = _windows_1252()


def _encode(s: str, encoding: str) -> bytes | None:
    try:
        if encoding == "cp1252":
            return bytes(_W1252[c] for c in s)
        return s.encode(encoding)
    except (UnicodeEncodeError, KeyError):
        return None


def _decode(b: bytes, encoding: str) -> str | None:
    try:
        return b.decode(encoding)
    except UnicodeDecodeError as e:
        # a value may be cut within its last character
        if encoding == "utf-8" and e.reason == "unexpected end of data" and e.start > 2 and e.start >= len(b) - 3:
            return b[: e.start].decode(encoding)
        return None


@lru_cache(maxsize=1 << 16)
def _char_cost(c: str) -> float:
    o = ord(c)
    if o < 0x80:
        return 0.0 if 0x20 <= o < 0x7F or c in "\t\r\n" else 3.0
    if 0xAC00 <= o <= 0xD7A3:
        try:
            return 0.0 if len(c.encode("euc_kr")) == 2 else 1.5
        except UnicodeEncodeError:
            return 1.5  # a syllable outside the common set
    if 0x1100 <= o <= 0x11FF or c in USUAL or 0xFF01 <= o <= 0xFF5E:
        return 0.3
    if o < 0xA0 or c == "�" or 0xE000 <= o <= 0xF8FF:
        return 4.0
    return 1.0 if unicodedata.category(c)[0] == "L" else 1.5


def cost(s: str) -> float:
    """Garbling cost: 0 for printable ASCII and common Hangul."""
    return sum(map(_char_cost, s))


def _reads(t: str, hangul: int) -> bool:
    """Plain text with at least so many Hangul syllables."""
    n = 0
    for c in t:
        k = _char_cost(c)
        if "가" <= c <= "힣":
            n += 1
        elif k > 0.3:
            return False
    return n >= hangul


def _letters_only(s: str) -> bool:
    return all(unicodedata.category(c)[0] == "L" for c in s)


def _candidates(s: str, alone: bool) -> list[str]:
    """Readings of a stretch that pass as the text that was meant, UTF-8 read as a Western encoding alone if there is one.

    alone: no ASCII letter touches the stretch.
    """
    western, other = [], []
    for e in ("latin-1", "cp1252", "mac_roman"):
        b = _encode(s, e)
        if b is None or b.isascii():
            continue
        t = _decode(b, "utf-8")
        if t is not None and not t.isascii():
            western.append(t)
        t = _decode(b, "cp949") if e != "mac_roman" else None
        if t is not None and _reads(t, 1):
            several = sum("가" <= c <= "힣" for c in t) > 1
            if several or (all(x >= 0xA1 for x in b if x > 0x7F) and (alone if _letters_only("".join(RUN.findall(s))) else True)):
                other.append(t)
    if western:
        return western
    for e in ("gbk", "cp932", "big5", "cp949"):
        b = _encode(s, e)
        if b is None:
            continue
        t = _decode(b, "utf-8")
        if t is not None and not t.isascii() and len(b) > 2 and _reads(t, 1):
            other.append(t)
        if e in ("gbk", "big5") and all("㐀" <= c <= "鿿" for c in "".join(RUN.findall(s))):
            t = _decode(b, "euc_kr")
            if t is not None and _reads(t, 1):
                other.append(t)
    if len(s) > 1 and all(ord(c) > 0xFF for c in s if not c.isascii()):
        b = _encode(s, "utf-16-le")
        t = b.decode("utf-16-be", "replace") if b is not None else None
        if t is not None and "\x00" not in t and _reads(t, 0):
            other.append(t)
    return other


def _once(v: str) -> str | None:
    """The reading of v, whole or in part, that costs least, if it costs less than v."""
    base = cost(v)
    if base == 0:
        return None
    best, best_cost = None, base - 0.25
    options = [t for t in _candidates(v, True)]
    for pattern in (WORD, RUN):
        pieces, changed, at = [], False, 0
        for m in pattern.finditer(v):
            s = m[0]
            pieces.append(v[at : m.start()])
            at = m.end()
            own = cost(s)
            if own > 0.5:
                alone = not ((m.start() and v[m.start() - 1].isalpha() and v[m.start() - 1].isascii()) or (at < len(v) and v[at].isalpha() and v[at].isascii()))
                read = min(_candidates(s, alone), key=cost, default=None)
                if read is not None and cost(read) < own - 0.25:
                    s, changed = read, True
            pieces.append(s)
        if changed:
            options.append("".join(pieces) + v[at:])
    for t in options:
        c = cost(t)
        if c < best_cost:
            best, best_cost = t, c
    return best


def repair(value: str | None) -> tuple[bool, str | None]:
    """(garbled, restored): restored is null if the text is not garbled or cannot be restored in full."""
    if not value or value.isspace():
        return False, None
    v = JAMO.sub(lambda m: unicodedata.normalize("NFC", m[0]), value)
    if value.isascii():
        return "??" in v, None
    text, layers = v, 0
    while (t := _once(text)) is not None:  # the cost falls each time, so it ends
        text, layers = t, layers + 1
    lost = LOST.search(v) is not None
    if not layers:
        return lost, None
    return True, None if LOST.search(text) else text


def garbled_cells(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """key, field_name, value, restored: the cells of the columns whose text is garbled."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("c")
    suspects = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"), cells).select("key", "c.field_name", "c.value").where(F.col("value").rlike(SUSPECT))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            known = {v: repair(v) for v in b.value.unique()}
            found = b[b.value.map(lambda v: known[v][0])]
            yield found.assign(restored=found.value.map(lambda v: known[v][1]).astype(object))

    return suspects.mapInPandas(run, "key bigint, field_name string, value string, restored string").withColumnRenamed("key", key)
