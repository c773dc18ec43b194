"""Text functions: transliteration to ASCII (P1) and percent strings.

Transliteration is a pure column expression: one ``translate`` for the
letters that map 1:1 onto an ASCII letter plus a few ``replace`` calls for
letters that expand (``ß`` -> ``ss``). The 1:1 table is derived by rule
from Unicode canonical decomposition (a Latin letter whose NFKD form is one
ASCII letter followed by combining marks), so no per-row Python runs.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Latin letters without a decomposition, and their ASCII spelling.
EXPANSIONS = {
    "ß": "ss", "ẞ": "SS", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe",
    "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l",
    "Þ": "TH", "þ": "th", "Ð": "D", "ð": "d", "ı": "i", "Ħ": "H", "ħ": "h",
    "º": "o", "ª": "a", "–": "-", "—": "--", "‘": "'", "’": "'", "“": '"', "”": '"', "…": "...", "€": "EUR",
    "¡": "!", "¿": "?", "«": "<<", "»": ">>", "¹": "1", "²": "2", "³": "3", "\u00a0": " ",
}

# Latin-1 Supplement, Latin Extended-A/B and Latin Extended Additional.
_RANGES = ((0x00C0, 0x0250), (0x1E00, 0x1F00))


def _one_to_one() -> tuple[str, str]:
    src, dst = [], []
    for lo, hi in _RANGES:
        for cp in range(lo, hi):
            ch = chr(cp)
            if ch in EXPANSIONS or not ch.isalpha():
                continue
            d = unicodedata.normalize("NFKD", ch)
            if len(d) > 1 and d[0].isascii() and d[0].isalpha() and all(unicodedata.combining(x) for x in d[1:]):
                src.append(ch)
                dst.append(d[0])
    return "".join(src), "".join(dst)


TRANSLATE_FROM, TRANSLATE_TO = _one_to_one()
# Combining Diacritical Marks: no counterpart in the target, so ``translate`` deletes them.
COMBINING = "".join(map(chr, range(0x0300, 0x0370)))


def transliterate_col(c: Column) -> Column:
    """P1 for one column; NULL stays NULL."""
    single = {ch: rep for ch, rep in EXPANSIONS.items() if len(rep) == 1}
    out = F.translate(c, "".join(single) + TRANSLATE_FROM + COMBINING, "".join(single.values()) + TRANSLATE_TO)
    for ch, rep in EXPANSIONS.items():
        if len(rep) > 1:
            out = F.replace(out, F.lit(ch), F.lit(rep))
    return out


def transliterate(df: DataFrame, cols=None) -> DataFrame:
    """Transliterate the given (default: all string) columns."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[transliterate_col(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def percent_text(c: Column, digits: int = 1) -> Column:
    """``'12.3%'`` from a percent value (JVM ``%.1f`` formatting)."""
    return F.format_string(f"%.{digits}f%%", c)
