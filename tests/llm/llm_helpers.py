"""Texts and tables for the tests."""

SF_SMALL = "/root/testdata/sf0.001"

WORDS = "the of and to in that is was for it with as his on be at by had not are but from or have an they which".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "ly", "ing", "ation", str(rng.randrange(50))]) for _ in range(n))


def agrees(spark, name):
    """The query equals its SQL on the smallest tables."""
    from compare import compare, duck
    r = compare(spark, duck(SF_SMALL), name, SF_SMALL)
    assert r["status"] == "OK", r
