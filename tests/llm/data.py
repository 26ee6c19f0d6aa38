"""Small inputs with the awkward cases, and plain versions of the operators' rules."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(LOWER))


def prose(seed: int, n: int, size: int = 60) -> list[str]:
    """n words of a small vocabulary with non-ASCII ones."""
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdeéñß") for _ in range(rnd.randint(1, 6))) for _ in range(size)]
    return [rnd.choice(pool) for _ in range(n)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)
