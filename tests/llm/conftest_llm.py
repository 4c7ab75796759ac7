"""Brute-force helpers of these tests."""

import re
import zlib


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def space_words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def crc(ids):
    import numpy as np

    return zlib.crc32(np.array(ids, "<u4").tobytes())


def path(name):
    import public_tokenizers

    return public_tokenizers.path(name)
