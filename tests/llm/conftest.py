import datetime
import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, taken long, "
          "_text string, _lines string, removed long, doc long, mark long, `length` long, root long")
VOCAB = [a + b for a in ("ba", "ri", "to", "ne", "lu") for b in ("n", "lka", "st", "m", "vo", "ri")]


def sentence(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def corpus_rows():
    """Documents with nulls, blanks, copies, near copies, shared passages, ties and a long text."""
    rng = random.Random(7)
    passage = sentence(rng, 70)
    near = sentence(rng, 120).split()
    rows = [(1, None, "en", "b"), (2, "", "en", None), (3, "  \n\t ", None, "a"), (4, "one two", "en", "a"),
            (5, "One TWO", "en", "c"), (6, "x", "en", "a")]
    rows += [(10 + i, sentence(rng, 20 + 3 * i) + "\nshared line of the site here\n" + sentence(rng, 15), "en", f"s{i % 13}")
             for i in range(30)]
    rows += [(50 + i, sentence(rng, 30) + " " + passage + " " + sentence(rng, 5 * i), "en", "hot") for i in range(12)]
    for i in range(14):
        words = list(near)
        for k in range(i % 4):
            words[(7 * i + 11 * k) % len(words)] = f"edit{i}x{k}"
        rows.append((80 + i, " ".join(words), "en", "hot"))
    rows += [(100 + i, "the very same text again and again\nin two lines é ß 漢", "en", f"s{i}") for i in range(14)]
    rows += [(120, sentence(rng, 6000), "en", "long"), (121, "A" * 20000, "en", "long"),
             (122, ("word " * 400).strip(), "en", "long"), (123, "tok|en #x# <b> " * 40, "en", "a"),
             (124, "UPPER Lower no break wide  two\x0bvt <|endoftext|> it's we'll \\ [INST]", "en", None)]
    rows += [(4, "one two", "en", "a"), (4, "another text under the same id", "en", "a")]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(*r, 0, 1, 2, "t", "l", 3, 4, 5, 6, 7) for r in corpus_rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id").cache()


@pytest.fixture(scope="session")
def rows():
    return corpus_rows()


@pytest.fixture(scope="session")
def with_null_id(docs):
    """The same with two rows without an id, that copy a document."""
    extra = docs.filter("doc_id = 50").selectExpr("cast(null as long) AS doc_id", *[f"`{c}`" for c in docs.columns[1:]])
    return docs.unionByName(extra).unionByName(extra)


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


@pytest.fixture(scope="session")
def check_dir(spark, docs, tmp_path_factory):
    """A folder of tables like the given ones, holding the fixture documents with labels."""
    folder = tmp_path_factory.mktemp(f"tables-{datetime.date.today():%j}")
    docs.select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i not in (120, 123)), 0) for i in range(10, 124)],
                          "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    return str(folder)
