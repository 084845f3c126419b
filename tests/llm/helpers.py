"""Plain-Python readings of the contracts, to hold the operators against."""

import re
import string
import zlib

DOCS = "doc_id long, text string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def crc(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def split(pattern, text):
    return re.findall(pattern, (text or "").translate(LOWER))


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)
