import random
import sys

from quizloom.functions import text

SPACES = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]


def samples(n=300, seed=1):
    rng = random.Random(seed)
    alphabet = [*SPACES, "a", "b", "é", "​", "\r\n"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(n)]


def test_whitespace_is_what_python_strips():
    assert set(text.WHITESPACE) == set(SPACES)


def test_strip_counts_and_lines_agree_with_python(evaluate):
    values = samples()
    assert evaluate(text.strip, values) == [v.strip() for v in values]
    assert evaluate(text.word_count, values) == [len(v.split()) for v in values]
    assert evaluate(text.split_lines, values) == [v.splitlines() for v in values]
    assert evaluate(text.words, values) == [v.lower().split() for v in values]


def test_min_words(evaluate):
    values = ["w " * 19, "w " * 20, " " + "w " * 19 + "w", "w\x1c" * 20, "", None]
    assert evaluate(lambda x: text.has_min_words(x, 20), values) == [False, True, True, True, False, None]
    values = samples(seed=2)
    for n in (1, 2, 3):
        assert evaluate(lambda x: text.has_min_words(x, n), values) == [len(v.split()) >= n for v in values]
    assert evaluate(lambda x: text.has_min_words(x, 0), ["", None]) == [True, False]
