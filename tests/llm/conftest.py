import random

import pytest

from surveyspark.llm.queries import on_workers

SYLLABLES = ["ba", "ko", "ri", "tel", "mun", "sa", "vor", "ne", "dil", "pra", "shu", "go"]


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    on_workers(spark)


@pytest.fixture
def prose():
    """prose(seed, n): n invented words in sentences."""
    def make(seed, n):
        rnd = random.Random(seed)
        out = []
        for k in range(n):
            word = "".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 4)))
            out.append(word + (". " if k % 9 == 8 else " "))
        return "".join(out).strip() + "."
    return make


@pytest.fixture
def documents(spark):
    """documents([(doc_id, text), ...]) with extra columns whose names the operators also use."""
    def make(rows):
        data = [(i, t, "xx", "s", 7, 1, 2, "m") for i, t in rows]
        return spark.createDataFrame(
            data, "doc_id long, text string, lang string, source string, n_chars long, h long, n long, mark string")
    return make
