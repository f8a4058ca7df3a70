"""Small corpora with the awkward cases: nulls, empty and long texts, copies, repeated rows, clashing column names."""

import random

CLASHING = "doc_id long, text string, uid string, row string, body string, id string, kept string, score string, copies string"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    parts = "er in on th nd ed ou re ti st sh ha wh he en an at es or ea".split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(words))


def rows() -> list[tuple[int | None, str | None]]:
    passage, long_passage = prose(1, 70), prose(2, 130)
    return [
        (1, prose(10, 200)),
        (2, prose(10, 200)),
        (3, prose(11, 50) + " " + passage + " " + prose(12, 40)),
        (4, prose(13, 30) + " " + passage + "\n" + prose(14, 20)),
        (5, passage + " " + prose(15, 60) + "\t" + passage),
        (6, long_passage + " " + prose(16, 10)),
        (7, "Ünïcödé " + long_passage + " ß"),
        (8, ""),
        (9, None),
        (None, prose(17, 90)),
        (10, "word"),
        (11, "a " * 900),
        (12, prose(18, 3000)),
        (13, prose(19, 120)),
        (13, prose(19, 120)),
        (14, prose(20, 60) + " " + passage[:390]),
        (14, prose(21, 60)),
        (15, " \n\t "),
    ]


def frame(spark, data=None):
    data = rows() if data is None else data
    return spark.createDataFrame([(i, t, *["x"] * 7) for i, t in data], CLASHING)


def empty(spark):
    return spark.createDataFrame([], CLASHING)
