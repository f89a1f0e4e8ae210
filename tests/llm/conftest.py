import random

import pytest

WORDS = [f"{a}{b}" for a in "ba ce di fo gu la me ni ro su".split() for b in "ta ve xi po ku".split()]


@pytest.fixture(scope="session")
def corpus():
    """Rows (id, text) with exact and near copies, shared passages, ties, nulls, empty and very long texts."""
    rng = random.Random(7)

    def prose(n):
        out = []
        while n > 0:
            k = min(n, rng.randint(4, 14))
            out.append(" ".join(rng.choice(WORDS) for _ in range(k)).capitalize() + rng.choice(".!?"))
            n -= k
        return " ".join(out)

    def edited(text, share):
        w = text.split(" ")
        for i in range(len(w)):
            if rng.random() < share:
                w[i] = rng.choice(WORDS)
        return " ".join(w)

    base, passage = prose(150), prose(60)
    rows = [(i, prose(rng.randint(1, 200))) for i in range(60)]
    rows += [(100 + i, edited(base, 0.01 * (i % 5))) for i in range(40)]
    rows += [(200 + i, prose(40) + "\n" + passage + "\n" + prose(40)) for i in range(20)]
    rows += [(300 + i, base) for i in range(5)] + [(310, None), (311, ""), (312, " \n\t"), (313, "one two"), (314, "ONE  two"), (315, "one"), (316, prose(30000))]
    return rows


@pytest.fixture(scope="session")
def documents(spark, corpus):
    rows = [(i, t, "en", None if i % 9 == 0 else f"s{i % 4}", len(t or ""), "extra", 1) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, hash string, node int")
