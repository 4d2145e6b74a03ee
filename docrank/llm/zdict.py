"""Compressors primed with raw text, and the normal form of the text they see."""

from __future__ import annotations

import re
import sys

import zstandard
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower case, every run of other characters than letters as one space."""
    return NOT_LETTERS.sub(" ", text.lower()).strip()


def primed(content: bytes, **parameters: int) -> zstandard.ZstdCompressor:
    """A compressor that has ``content`` as raw dictionary; its frames hold nothing but the data."""
    p = zstandard.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False, **parameters)
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(compression_params=p, dict_data=d)


def windows(data: bytes, size: int) -> list[bytes]:
    """``data`` in runs of at most ``size`` bytes, cut at spaces where there are any; the space begins the next run."""
    out, lo, n = [], 0, len(data)
    while n - lo > size:
        hi = data.rfind(b" ", lo + 1, lo + size)
        hi = hi if hi > lo else lo + size
        out.append(data[lo:hi])
        lo = hi
    out.append(data[lo:])
    return out
