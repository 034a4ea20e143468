import pytest

WORDS = "the of and nt ere tion ing ou es on re st er th in at ed he is an".split()


def sentence(seed, n):
    out, state = [], seed * 7919 + 13
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(WORDS[state >> 40 & 15] + WORDS[state >> 50 & 15])
    return " ".join(out)


@pytest.fixture(scope="session")
def passage():
    return sentence


@pytest.fixture(scope="session")
def corpus():
    """(id, text): copies, near copies, a shared passage, self-repeats, nulls, blanks, repeated rows,
    odd white space, a very long text, and one id with two texts."""
    base, shared = sentence(1, 90), sentence(2, 60)
    rows = [(i, sentence(10 + i, 40 + i)) for i in range(12)]
    rows += [(20, base), (21, base), (22, base + " and more"), (23, "x " + base)]
    rows += [(30 + i, f"{sentence(60 + i, 12)}\n{shared} {sentence(80 + i, 9)}") for i in range(9)]
    rows += [(50, "abcdefghij" * 60), (51, "a" * 450), (52, f"{shared} {shared}")]
    rows += [(60, None), (61, ""), (62, " \t\n"), (63, "é…日本\u0301 ñandú\u00a0x"), (None, base), (None, None)]
    rows += [(70, sentence(5, 50)), (70, sentence(5, 50)), (71, sentence(6, 50)), (71, sentence(7, 50))]
    rows += [(80, sentence(90, 30_000))]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns whose names the operators use inside."""
    rows = [(i, t, f"s{n % 3}", n, "x", None) for n, (i, t) in enumerate(corpus)]
    schema = "doc_id long, text string, source string, k1 long, m string, fp long"
    return spark.createDataFrame(rows, schema).repartition(3).cache()
