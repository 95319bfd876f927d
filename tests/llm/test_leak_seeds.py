"""Every placing of substitutions that decontamination allows is found."""

from itertools import combinations

import pytest

pytest.importorskip("curveloom.llm")

from curveloom.llm import decontamination  # noqa: E402


def swapped(words, at):
    return " ".join("zz" if k in at else w for k, w in enumerate(words))


@pytest.mark.parametrize("n", [*range(5, 14), 30])
def test_all_substitutions_allowed_are_found(n):
    words = [f"w{n}x{k}" for k in range(n)]
    index = decontamination.SeedIndex([(1, " ".join(words))])
    size, first = min(13, n), n // 3 if n > 13 else 0
    quoted = words[first : first + size]
    allowed = size // 5
    patterns = [at for m in range(allowed + 1) for at in combinations(range(size), m)]
    texts = [f"before it {swapped(quoted, at)} after it".encode() for at in patterns]
    found = {t: start for t, _, _, _, _, start in index.search(texts)}
    assert [patterns[t] for t in range(len(texts)) if t not in found] == []
    over = [f"before it {swapped(quoted, at)} after it".encode() for at in combinations(range(size), allowed + 1)]
    assert index.search(over) == []
