"""Short phrases that recur with other words between them."""

import random

import pytest

from lexmill.llm import repetition


@pytest.mark.parametrize(("size", "times"), [(5, 3), (4, 3), (4, 12), (3, 8)])
def test_phrases_with_other_words_between(size, times):
    words = [w for k in range(times) for w in [*(f"p{i}" for i in range(size)), f"x{k}"]]
    assert repetition.repeated(words)[0] == size * (times - 1)


def test_chance_repeats_do_not_count():
    r = random.Random(4)
    bigrams = [w for k in range(40) for w in ("of", "the", f"x{k}", f"y{k}")]
    twice = [*"abcd", "x", *"abcd", "y"]
    assert repetition.repeated(bigrams)[0] == repetition.repeated(twice)[0] == 0
    assert repetition.repeated([f"w{int(r.paretovariate(0.7))}" for _ in range(400)])[0] < 0.4 * 400
