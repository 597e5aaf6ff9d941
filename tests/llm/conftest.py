import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def hard_rows():
    """Empty, null, blank, very short and very long texts; ties; copies; near copies; shared passages."""
    import random

    r = random.Random(5)
    vocab = ["".join(r.choice("abcdefghiABCé") for _ in range(r.randint(1, 7))) for _ in range(400)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    rows, k = [], 1000

    def add(t):
        nonlocal k
        k += 7
        rows.append((k, t, "en", "s", len(t or "")))

    for t in (None, "", "   \n\t ", "one", "ONE", "one two", "a b c d", "A b c d", "a b c d e", "a\x0bb\x0cc d e", "a b c d e f"):
        add(t)
    base = say(120)
    for _ in range(45):  # a large family: more than a group's limit
        w = base.split()
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = r.choice(vocab)
        add(" ".join(w))
    passage = say(70)
    for _ in range(60):
        add(say(r.randint(3, 60)) + "\n" + passage + " " + say(r.randint(3, 60)))
    for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 16, 17, 20, 60, 64, 65, 70):
        t = say(n)
        for m in (0, 1, 2, n // 7, n // 3):
            add(" ".join((t.split() + say(m).split()) if m else t.upper().split()))
    long = say(30000)
    add(long)
    add(long + " " + say(3000))
    add(say(50) + " " + long[: len(long) // 2])
    rep = say(30)
    add(" ".join([rep] * 20))
    add(" ".join([rep] * 25))
    return rows


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(5, "doc_id")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
