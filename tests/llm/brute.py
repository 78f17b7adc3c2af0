"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import cache
from itertools import combinations

import duckdb

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def rows(folder: str, name: str) -> list[tuple]:
    return duckdb.sql(f"SELECT * FROM read_parquet('{folder}/{name}.parquet')").fetchall()


@cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids(text: str | None, end: int = 2) -> list[int]:
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, end]


def crc(values: list[int]) -> int:
    return zlib.crc32(b"".join(v.to_bytes(4, "little") for v in values))


def shingles(text: str | None) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def classes(docs: list[tuple]) -> dict[int, tuple[int, int]]:
    """doc_id to set size and least reachable id, for distinct ids."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        inner = len(sets[a] & sets[b])
        if inner and 100 * inner >= 80 * (len(sets[a]) + len(sets[b]) - inner):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def digest(turns: list[tuple[str, str]]) -> tuple:
    said = "".join(t for r, t in turns if r == "assistant")
    return (
        len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
        len(said), hashlib.sha256(said.encode()).hexdigest(),
    )
