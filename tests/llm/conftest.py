import random

import pytest

WORDS = "the of and to in is that for it was on with as be by at from this have or one had but not what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and columns of clashing names."""
    rng = random.Random(11)
    long = "\n".join(prose(rng, 60) for _ in range(700))
    base = [(k, prose(rng, rng.randint(1, 80)).replace(" and ", ".\n"), "en", f"s{k % 3}") for k in range(40)]
    base += [(100, None, None, None), (101, "", "en", "s0"), (102, " \n\t ", "en", "s1"), (103, long, "en", "s1"), (104, "x" * 30_000, "en", "s2")]
    base += [(105, base[3][1], "en", "s0"), (106, base[3][1], None, "s1"), base[5], base[5], (5, "another text of the same id", "en", "s0"), (None, "no id here", "en", "s0"), (None, None, None, None)]
    base += [(107, "É'll 漢字 don't 12 !!   é\r\n", "fr", "s2"), (108, "<|endoftext|> a", "en", "s0"), (109, "one two three", "en", "s0")]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, node bigint, shard int, epoch int, tokens int, weight double, link string"
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 0.5, 7, 3, 1, 2, 0.1, "l") for r in base], names).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
