import random

import pytest

WORDS = "the refund left pending account before close shop clerk noted buyer asked for copy of receipt and settled item with bank".split()


def sentence(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(6, 14))).capitalize() + rng.choice(".?!")


@pytest.fixture(scope="session")
def writer():
    """Makes a text of whole sentences of about so many characters."""

    def make(seed, chars):
        rng, out = random.Random(seed), ""
        while len(out) < chars:
            out += (" " if out else "") + sentence(rng)
        return out

    return make
