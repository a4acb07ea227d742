"""Awkward documents that every operator has to get through."""

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_lines string, _node long, n_tokens string, score string, kept string, _q_n_words long"
)

TEXTS = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t\x0b \n", "en", "a"),
    (4, "one two", "en", "a"),
    (4, "one two", "en", "a"),
    (5, "One  TWO", "en", None),
    (None, "no id at all here", "en", "b"),
    (None, "no id at all here", "en", "b"),
    (None, None, None, None),
    (6, "word " * 60_000, "en", "b"),
    (7, "x" * 70_000, None, "c"),
    (8, "日本語 テスト 😀😀 é ß\r\nİ ǅ", "ja", "ü"),
    (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", "c"),
    (10, "12 34.5 !?", "en", "c"),
    (4, "other text of the same id", "de", "a"),
]


def documents(spark, texts=None):
    """The documents with extra columns whose names operators might want."""
    rows = [
        (i, t, lang, source, None if t is None else len(t), "l", 7, "t", "s", "k", 3)
        for i, t, lang, source in (TEXTS if texts is None else texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def given(spark, table="documents", sf=SF):
    return spark.read.parquet(f"{sf}/{table}.parquet")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def tokens(text):
    return (text or "").encode().lower().split()
