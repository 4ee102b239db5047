import datetime
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def documents(spark):
    """A documents table from texts (ids from 0), with columns whose names operators use inside."""
    def make(texts, ids=None, source="src0", **more):
        rows = [(None if ids and ids[i] is None else int(ids[i]) if ids else i, t, "en", source if isinstance(source, str) else source[i],
                 None if t is None else len(t), "x", i, datetime.date(2020, 1, 1)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                           "id string, key bigint, value date")
    return make
