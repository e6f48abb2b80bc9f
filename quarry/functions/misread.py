"""Repair of text whose UTF-8 bytes were read in another encoding, once or several times, and of other marks that conversions leave.

A run of characters beyond ASCII is taken back to bytes in each encoding that it may have been read in, and the bytes that make sound UTF-8 become
their characters; of the ways that this gives the cheapest is taken, and the search goes on from there until no way is cheaper.
What costs is a character beyond ASCII, signs more than letters, control characters most; so a repair always makes the text
shorter, and text that is sound stays. Characters of rare scripts and unassigned ones are never made.
"""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

#: Encodings that text is misread in; the bytes that the first leaves undefined pass as control characters.
ENCODINGS = ("cp1252", "mac_roman")
_RUN = re.compile(r"[^\x00-\x7f]{2,}")
_SEQUENCE = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
#: Quotes and what they are folded to.
QUOTES = str.maketrans({"‘": "'", "’": "'", "‚": "'", "‛": "'", "ʼ": "'", "“": '"', "”": '"', "„": '"', "‟": '"'})
_WIDE = re.compile(r"[\uff01-\uff5e\uff61-\uffdc\uffe0-\uffee\u3000]+")
_LIGATURES = re.compile(r"[\ufb00-\ufb06\u0132\u0133]")
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0e-\x1f\x7f\ufeff\u206a-\u206f]")


@lru_cache(maxsize=4)
def _bytes_of(encoding: str) -> dict[str, int]:
    """Characters that stand for bytes from 128 on."""
    out = {chr(b): b for b in range(0x80, 0xA0)} if encoding == "cp1252" else {}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            continue
    return out


def cost(text: str) -> float:
    """What the characters beyond ASCII of a text cost."""
    return sum(0.0 if c < "\x80" else 4.0 if c < "\xa0" or c == "\ufffd" else 1.0 if c.isalpha() else 1.5 for c in text)


def _sound(c: str) -> bool:
    """Whether a reading may make this character: of the short sequences Latin, Greek, Cyrillic, Hebrew and Arabic, of the others what is assigned."""
    n = ord(c)
    if n < 0x800:
        return n < 0x250 or 0x370 <= n < 0x530 or 0x5D0 <= n < 0x700 or c in "ˆ˜"
    return unicodedata.category(c) not in ("Cn", "Co", "Cs")


def reread(run: str, encoding: str) -> str:
    """The run with those of its characters whose bytes make sound UTF-8 read as that; the others stay."""
    table = _bytes_of(encoding)
    data = bytes(table.get(c, 0x20) for c in run)  # a space ends any sequence
    out, at = [], 0
    for m in _SEQUENCE.finditer(data):
        try:
            c = m[0].decode("utf-8")
        except UnicodeDecodeError:
            continue
        if _sound(c):
            out += [run[at : m.start()], c]
            at = m.end()
    return "".join([*out, run[at:]])


def repair_run(run: str) -> str:
    """The cheapest reading that the search finds."""
    best, price = run, cost(run)
    while True:
        ways = [(cost(w), n, w) for n, w in enumerate(reread(best, e) for e in ENCODINGS)]
        now, _, way = min(ways)
        if now >= price:
            return best
        best, price = way, now


def repair(text: str) -> str:
    """Misread runs repaired; nothing else."""
    return text if text.isascii() else _RUN.sub(lambda m: repair_run(m[0]), text)


def fix(text: str) -> str:
    """All repairs until nothing changes (eight rounds at most): pairs of surrogates, references (where the text has no tag), misread runs,
    ligatures, wide characters, quotes folded to straight ones, line ends, control characters; composed at the end."""
    for _ in range(8):
        now = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if re.search("[\ud800-\udfff]", text) else text
        if "<" not in now and "&" in now:
            now = html.unescape(now)
        now = repair(now)
        now = _LIGATURES.sub(lambda m: unicodedata.normalize("NFKC", m[0]), now)
        now = _WIDE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), now)
        now = now.translate(QUOTES).replace("\r\n", "\n").replace("\r", "\n").replace("\u2028", "\n").replace("\u2029", "\n").replace("\x85", "\n")
        now = unicodedata.normalize("NFC", _CONTROL.sub("", now))
        if now == text:
            break
        text = now
    return text
