"""Text of bodies in the charset they state (SRC-03).

The charset is that of a byte order mark, else of the capture's content type,
else of a ``meta`` element among the first bytes, else UTF-8.  Decoding stays
in the JVM: UTF-8 with U+FFFD for what is malformed; a single-byte charset is
read as Latin-1 and its upper half translated by the charset's own table, with
U+FFFD for bytes it doesn't define.  Labels that are not known count as absent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels of charsets with one byte a character, and the codec each is read by.
#: Pages that say Latin-1 or ASCII are read as windows-1252.
SINGLE_BYTE = {f"windows-125{i}": f"cp125{i}" for i in range(9)} | {f"cp125{i}": f"cp125{i}" for i in range(9)}
SINGLE_BYTE |= {f"iso-8859-{i}": f"iso8859_{i}" for i in (2, 3, 4, 5, 6, 7, 8, 10, 13, 14, 15, 16)}
SINGLE_BYTE |= {label: "cp1252" for label in ("iso-8859-1", "iso8859-1", "latin1", "latin-1", "us-ascii", "ascii")}
SINGLE_BYTE |= {"iso-8859-9": "cp1254", "latin2": "iso8859_2", "koi8-r": "koi8_r", "koi8-u": "koi8_u", "macintosh": "mac_roman", "tis-620": "cp874"}
UTF_8 = ("utf-8", "utf8")
#: Bytes in which a ``meta`` element is looked for.
META_BYTES = 1024
LABEL_RE = r"""charset\s*=\s*["']?\s*([a-z0-9_.:-]+)"""


def _known(label: Column) -> Column:
    low = F.lower(label)
    return F.when(low.isin(*UTF_8, *SINGLE_BYTE), F.when(low.isin(*UTF_8), F.lit("utf-8")).otherwise(low))


def charset(content: Column, content_type: Column | None = None) -> Column:
    """The label a binary ``content`` is read by; ``content_type`` is the header's value."""
    mark = F.substring(F.hex(F.substring(content, 1, 3)), 1, 6)
    head = F.lower(F.decode(F.substring(content, 1, META_BYTES), "ISO-8859-1"))
    header = F.lit(None) if content_type is None else _known(F.regexp_extract(F.lower(content_type), LABEL_RE, 1))
    meta = _known(F.regexp_extract(F.regexp_extract(head, r"(<meta\s[^>]*charset\s*=[^>]*)", 1), LABEL_RE, 1))
    return F.coalesce(F.when(mark == "EFBBBF", F.lit("utf-8")), header, meta, F.lit("utf-8"))


def decode(content: Column, label: Column) -> Column:
    """``content`` as text by a label of ``charset``; a byte order mark goes."""
    upper = bytes(range(128, 256))
    latin = upper.decode("latin-1")
    table = F.lit(latin)
    for codec in sorted(set(SINGLE_BYTE.values())):
        table = F.when(label.isin([k for k, v in SINGLE_BYTE.items() if v == codec]), F.lit(upper.decode(codec, "replace"))).otherwise(table)
    single = F.call_function("translate", F.decode(content, "ISO-8859-1"), F.lit(latin), table)
    utf8 = F.regexp_replace(F.make_valid_utf8(content.cast("string")), "^﻿", "")
    return F.when(label == "utf-8", utf8).otherwise(single)
