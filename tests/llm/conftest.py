import random

import pytest

WORDS = "the of and a to in is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(id, text) rows: prose, copies, near copies, shared passages, nulls, empties, odd characters, one long text."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 30, 80, 200, 400])) for _ in range(60)]
    passage = prose(rng, 120)
    texts = list(base)
    texts += [base[3]] * 6 + [base[4]] * 2
    texts += [t.replace(" the ", " THE ", 1) for t in base[:6]]
    texts += [f"{prose(rng, 40)} {passage} {prose(rng, 40)}" for _ in range(12)]
    for t in base[5:15]:
        words = t.split(" ")
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [None, None, "", "", " ", "\t\n", "a", "A", "12 34 !!", "é" * 500 + "x", "ab" * 700, "z" * 3000, "don't we'll 's ''x _'s", "\x1c \x85 Σ ²", "中文 字 中文"]
    texts.append(prose(rng, 30_000))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus over several partitions, with columns that clash with results."""
    rows = [(i, t, "x", 7, True, "s", i % 3) for i, t in corpus]
    return spark.createDataFrame(
        rows, "doc_id long, text string, kept string, n_words int, n_removed boolean, score string, component_id int"
    ).repartition(5)


@pytest.fixture(scope="session")
def components_of():
    def run(n, links):
        parent = list(range(n))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        return [root(x) for x in range(n)]

    return run
