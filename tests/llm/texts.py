"""Texts and goals that the tests share."""

from fractions import Fraction


def long_text(words=40_000):
    return " ".join(f"w{i % 977}x{i}" for i in range(words))


# null, empty, blanks side by side, a special string, other scripts, repeats, long
TOKEN_TEXTS = [None, "", "hello world", "a  b\n\n c\t d", "x<|endoftext|>y", "Ünï cödé \u3000 テスト", "hello world", " lead and trail ",
               long_text(5000)]


def goals(sizes):
    """Words a mix takes of each source, weighing 3, 1, 2 and again: the level at which those below twice their size share the rest."""
    bounds = [(Fraction(2 * size, (3, 1, 2)[at % 3]), at) for at, size in enumerate(sizes)]
    rest, open_ = Fraction(3 * sum(sizes), 2), sum((3, 1, 2)[at % 3] for _, at in bounds)
    found = [0.0] * len(sizes)
    for bound, at in sorted(bounds):
        weight = (3, 1, 2)[at % 3]
        given = min(bound, rest / open_) * weight
        found[at] = float(given)
        rest, open_ = rest - given, open_ - weight
    return found
