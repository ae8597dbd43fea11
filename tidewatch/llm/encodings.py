"""What a text becomes when it is read in the wrong character encoding.

A chain is a list of steps ``(written, read)``: the text is encoded in the first and
decoded in the second. Bytes that the reader doesn't define are kept as
control characters, dropped, or replaced by U+FFFD; only the first loses nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

# The encodings of texts and the ones they are taken for.
#: Readers of texts written in UTF-8.
UTF8_READERS = ("cp1252", "latin-1", "cp1250", "cp1251", "iso8859_2", "cp437", "cp850", "mac_roman", "koi8_r", "gbk", "cp1253", "cp1254", "cp1257", "cp866", "iso8859_15", "iso8859_5", "cp852", "shift_jis", "big5", "euc_kr")
#: Readers that UTF-8 text meets twice or three times.
REPEATED = ("cp1252", "latin-1", "cp1251", "cp1250", "cp437", "mac_roman")
#: (written, read) of texts in older encodings.
LEGACY = (
    ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("cp1252", "cp1251"), ("cp1252", "cp1250"), ("cp1252", "koi8_r"),
    ("cp1251", "cp1252"), ("cp1251", "latin-1"), ("cp1251", "koi8_r"), ("cp1251", "cp866"), ("cp1251", "mac_cyrillic"), ("koi8_r", "cp1251"), ("koi8_r", "cp1252"), ("koi8_r", "latin-1"), ("cp866", "cp1251"), ("cp866", "cp1252"), ("iso8859_5", "cp1251"), ("iso8859_5", "cp1252"), ("mac_cyrillic", "cp1251"),
    ("cp1250", "cp1252"), ("cp1250", "iso8859_2"), ("iso8859_2", "cp1250"), ("iso8859_2", "cp1252"), ("iso8859_2", "latin-1"), ("cp852", "cp1252"), ("cp852", "cp1250"), ("cp1250", "cp852"), ("cp1250", "cp1251"),
    ("cp1253", "cp1252"), ("iso8859_7", "cp1252"), ("iso8859_7", "latin-1"), ("cp1253", "latin-1"), ("cp1254", "cp1252"), ("cp1254", "latin-1"), ("cp1257", "cp1252"),
    ("gbk", "cp1252"), ("gbk", "latin-1"), ("shift_jis", "cp1252"), ("shift_jis", "latin-1"), ("euc_jp", "cp1252"), ("euc_jp", "latin-1"), ("big5", "cp1252"), ("euc_kr", "cp1252"), ("shift_jis", "gbk"), ("gbk", "shift_jis"), ("gbk", "big5"), ("big5", "gbk"),
    ("cp1252", "utf-8"), ("cp1251", "utf-8"), ("cp1250", "utf-8"), ("iso8859_7", "utf-8"), ("gbk", "utf-8"), ("shift_jis", "utf-8"), ("mac_roman", "utf-8"), ("koi8_r", "utf-8"), ("cp437", "utf-8"), ("cp850", "utf-8"),
)

KEEP, DROP, REPLACE = "keep", "drop", "replace"

#: A token: letters, digits and everything beyond ASCII. Reading in the wrong encoding leaves ASCII as it is, so tokens end where they ended.
TOKEN = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
BEYOND = re.compile(r"[^\x00-\x7f]+")
DIGITS = re.compile(r"[0-9]+")


@lru_cache(maxsize=None)
def _single(encoding: str) -> tuple[tuple[str | None, ...], dict[str, int]] | None:
    """Byte to character and back, of a single-byte encoding."""
    if encoding in ("gbk", "shift_jis", "big5", "euc_kr", "euc_jp", "utf-8"):
        return None
    chars = []
    for b in range(256):
        try:
            chars.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            chars.append(None)
    back = {c: b for b, c in enumerate(chars) if c is not None}
    for b, c in enumerate(chars):
        if c is None:
            back.setdefault(chr(b), b)
    return tuple(chars), back


def read_as(data: bytes, encoding: str, mode: str) -> tuple[str, bool]:
    """``data`` decoded, and whether something was lost or put in for an undefined byte."""
    table = _single(encoding)
    if table is None:
        try:
            return data.decode(encoding), False
        except UnicodeDecodeError:
            return data.decode(encoding, {KEEP: "replace", REPLACE: "replace", DROP: "ignore"}[mode]), True
    out, lost = [], False
    for b in data:
        c = table[0][b]
        if mode == DROP and (c is None or 0x80 <= ord(c) < 0xA0):
            lost = True
        elif c is None:
            lost |= mode == REPLACE
            out.append(chr(b) if mode == KEEP else "�")
        else:
            out.append(c)
    return "".join(out), lost


def written_in(text: str, encoding: str) -> bytes | None:
    """``text`` encoded; undefined bytes that were kept as control characters go back to bytes. None if it can't be."""
    table = _single(encoding)
    if table is None:
        try:
            return text.encode(encoding)
        except UnicodeEncodeError:
            return None
    back = table[1]
    try:
        return bytes(back[c] for c in text)
    except KeyError:
        return None


def garbled_forms(word: str) -> Iterator[tuple[str, str, bool]]:
    """``(form, chain, lossless)`` of a word under every chain; forms equal to the word are left out."""
    seen = {word}
    data = word.encode("utf-8", "ignore")
    first: list[tuple[str, str, bool]] = []
    for reader in UTF8_READERS:
        for mode in (KEEP, DROP, REPLACE):
            form, lost = read_as(data, reader, mode)
            if form not in seen:
                seen.add(form)
                yield form, f"utf-8>{reader}", not lost
                if reader in REPEATED and mode != REPLACE:
                    first.append((form, reader, lost))
    for _ in range(2):  # read wrongly again, and once more
        again = []
        for text, chain, was_lost in first:
            for reader in REPEATED[:2] if chain.split(">")[0] in REPEATED[:2] else (chain.split(">")[0],):
                for mode in (KEEP, DROP):
                    form, lost = read_as(text.encode("utf-8"), reader, mode)
                    if form not in seen:
                        seen.add(form)
                        yield form, f"utf-8>{chain}>{reader}", not (lost or was_lost)
                        again.append((form, f"{chain}>{reader}", lost or was_lost))
        first = again
    for written, reader in LEGACY:
        raw = written_in(word, written)
        if raw is None:
            continue
        for mode in (KEEP, DROP, REPLACE):
            form, lost = read_as(raw, reader, mode)
            if form not in seen:
                seen.add(form)
                yield form, f"{written}>{reader}", not lost


def forward(text: str, chain: str) -> str | None:
    """``text`` under a chain such as ``utf-8>cp1252>cp1252``; None where a step loses something."""
    written, *readers = chain.split(">")
    for reader in readers:
        raw = written_in(text, written)
        if raw is None:
            return None
        text, lost = read_as(raw, reader, KEEP)
        if lost:
            return None
        written = "utf-8"
    return text


#: Encodings of two bytes a character, whose readings in a single-byte one can be cut into characters again.
PAIRED = tuple((w, r) for w, r in LEGACY if _single(w) is None and w != "utf-8" and _single(r) is not None)


def readings(run: str, depth: int = 3) -> Iterator[tuple[str, str]]:
    """``(text, chain)``: what a run beyond ASCII may have been, by every chain whose reading can be cut into characters.

    These are UTF-8 read in a single-byte encoding, up to ``depth`` times, and the older encodings of several bytes.
    """
    for reader in UTF8_READERS if len(run) > 1 else ():
        raw = written_in(run, reader) if _single(reader) is not None else None
        if raw is None:
            continue
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if len(text) < len(run):
            yield text, f"utf-8>{reader}"
            if depth > 1 and not text.isascii():
                yield from ((t, f"{c}>{reader}") for t, c in readings(text, depth - 1) if c.startswith("utf-8>"))
    for written, reader in PAIRED if len(run) > 5 and depth == 3 else ():
        raw = written_in(run, reader)
        try:
            text = raw.decode(written) if raw is not None else ""
        except UnicodeDecodeError:
            continue
        if len(text) * 2 <= len(run) and text:
            yield text, f"{written}>{reader}"


@lru_cache(maxsize=65536)
def _kind(c: str) -> tuple[str, str]:
    """``(category, script)`` of a character; the script is the first word of its name, one for all of East Asia."""
    category = unicodedata.category(c)
    if c in "\u00aa\u00ba\u00b5" or category == "Lm":  # letters by name, signs by use
        return "So", ""
    script = unicodedata.name(c, "").split(" ")[0] if category[0] == "L" else ""
    return category, "EAST" if script in ("CJK", "HIRAGANA", "KATAKANA", "HANGUL", "BOPOMOFO") else script


def oddness(word: str) -> int:
    """How unlike a written word: control characters, signs among letters, scripts and cases mixed within it, rows of accented letters. 0 for plain words.

    A word all in capitals counts 1, less than anything else. Marks such as (TM) or degrees beside an ASCII letter at either end are usual.
    """
    kinds = [_kind(c) for c in word]
    odd, accented, upper, letters = 0, 0, 0, 0
    for i, (c, (category, script)) in enumerate(zip(word, kinds)):
        before = kinds[i - 1] if i else ("", "")
        after = kinds[i + 1] if i + 1 < len(word) else ("", "")
        if category in ("Cc", "Cn", "Co", "Cs"):
            odd += 8
        elif category[0] == "S" or category == "No":
            edge = c in "\u2122\u00ae\u00a9\u00b0" and (not i or not after[0]) and (word[i - 1] if i else word[i + 1 : i + 2]).isascii()
            odd += 4 if (before[1] or after[1]) and not edge else 0
        elif category[0] == "P":
            odd += 2 if before[1] and (after[1] and c not in "\u2019\u2018\u2013\u2014\u2010\u2011\u00b7\u30fb" or c in "\u00bf\u00a1") else 0
        if script:
            letters += 1
            upper += category == "Lu"
            if before[1] and before[1] != script:
                odd += 2 if "EAST" in (script, before[1]) else 4
            elif before[0] == "Ll" and category == "Lu":
                odd += 2
            elif category == "Ll" and before[0] == "Lu" and i > 1 and kinds[i - 2][0] == "Lu" and (ord(c) > 127 or ord(word[i - 1]) > 127):
                odd += 2
            accented = accented + 1 if script == "LATIN" and ord(c) > 127 else 0
            odd += 2 * (accented > 2)
        else:
            accented = 0
    return odd + (letters > 2 and upper == letters)


def scripts(word: str) -> str:
    """The scripts of a word's letters, in order of their names."""
    return " ".join(sorted({k[1] for k in map(_kind, word) if k[1]}))
