import re
from collections import Counter

import pytest

SF = "/root/testdata/sf0.001"
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# extra columns whose names clash with those the operators use inside or return
DOCS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, _t string, "
        "_id string, n_words string, score string, key string, node int, c int, n int, "
        "`a b.c` int, kept string, _spans string, labels string")
PAGES = "page_id bigint, url string, html string, _id string, sha int, keeper int, text string"


def plain_words(text):
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def doc(i, text, **more):
    row = {"doc_id": i, "text": text, "lang": None, "source": "s", "n_chars": None, "_t": "x",
           "_id": "y", "n_words": "z", "score": None, "key": "k", "node": 1, "c": 2, "n": 3,
           "a b.c": 4, "kept": None, "_spans": "q", "labels": "l"}
    return tuple({**row, **more}.values())


def edge_texts():
    prose = " ".join(f"w{k} und{k % 7}" for k in range(40))
    return [
        (1, prose), (2, prose), (2, prose), (None, prose), (None, None), (3, None), (4, ""),
        (5, "   \n\t "), (6, "!!! ..."), (7, "one"), (8, "É é ß 漢字 \U0001F600 " * 5),
        (9, "spam " * 3000), (10, "x" * 300_000), (11, prose + " and one more word"),
        (12, "Released under the MIT License. token = 'abcdef0123456789abcdef01' AKIA" + "Z" * 16),
        (13, "line a b\nline a b\n\nline a b \n"), (14, "tab\tand  two   spaces \n \n x "),
        (-15, "\x00\x1c\x85　 odd spaces"),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [doc(i, t) for i, t in edge_texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3, "n")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, None), (2, 1, 0), (None, 1, 0), (9, 0, 0),
                                  (11, 1, 0), (77, 1, 1), (13, None, None)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def multiset(rows):
    return Counter(tuple(r) for r in rows)
