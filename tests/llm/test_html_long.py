import random

from quern.llm import html_text


def length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def test_order_counts_on_very_long_pages():
    a = list(range(5200))
    assert len(html_text.common_lines(a, a[::-1])) == 1


def test_cut_matrices_give_a_longest_common_subsequence(monkeypatch):
    rng = random.Random(6)
    for cells in (0, 4, 30):
        monkeypatch.setattr(html_text, "CELLS", cells)
        for _ in range(150):
            a, b = ([rng.randrange(6) for _ in range(rng.randrange(25))] for _ in range(2))
            at = html_text.common_lines(a, b)
            assert len(at) == length(a, b) and at == sorted(set(at))
            rest = iter(b)
            assert all(a[i] in rest for i in at)
