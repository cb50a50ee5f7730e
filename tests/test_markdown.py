import random
import re

import pytest
from pyspark.sql import functions as F

from vellum.functions import markdown

CORPUS = [
    ("", 0, 0, 0, 0, 0), ("# A\n\n## B\n", 0, 0, 0, 2, 0), ("####### seven", 0, 0, 0, 0, 0), ("#\n", 0, 0, 0, 1, 0), ("#", 0, 0, 0, 0, 0), ("#nospace", 0, 0, 0, 0, 0),
    ("| a | b |\n| --- | :-: |\n| 1 | 2 |", 0, 1, 0, 0, 0), ("| a |\n\n\n|---|", 0, 1, 0, 0, 0), (" | a |\n |---|", 0, 0, 0, 0, 0), ("<table><tr><td>1</td></tr></table>", 0, 0, 0, 0, 0),
    ("$$x$$ and $$y$$", 0, 0, 2, 0, 0), ("$$$", 0, 0, 0, 0, 0), ("$$a", 0, 0, 0, 0, 0), ("![a](x.png)![b](y.svg)![](z.JPEG)", 3, 0, 0, 0, 2), ('![a](x.png "title")', 1, 0, 0, 0, 0),
    ("![a](x.png?v=1)", 1, 0, 0, 0, 0), ("![a]()", 0, 0, 0, 0, 0), ("![a\nb](dir/c d.webp)", 1, 0, 0, 0, 1), ("![a](p(1).png)", 1, 0, 0, 0, 0), ("```\n# not heading\n```", 0, 0, 0, 1, 0),
    ("# a\x0b", 0, 0, 0, 1, 0), ("# x # y", 0, 0, 0, 1, 0), ("#\xa0nbsp", 0, 0, 0, 1, 0), ("| a |\r\n|---|", 0, 1, 0, 0, 0),
]
TOKENS = ["#", "##", " ", "\n", "\r", " ", "\xa0", "\x1c", "|", "| a |", "|---|", "$", "$$", "![", "](", ")", ".png", ".GIF", "x", "\\", "![a](b.jpg)", "\x85"]


def counts(spark, texts):
    md = F.col("md")
    return [tuple(r) for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, md string").orderBy("k").select(*markdown.statistics(md), markdown.captionable_count(md)).collect()]


def test_corpus(spark):
    assert counts(spark, [c[0] for c in CORPUS]) == [c[1:] for c in CORPUS]


def test_token_soup_equals_python(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choices(TOKENS, k=rnd.randrange(40))) for _ in range(2000)]
    found = lambda p, t, flags=0: len(re.findall(p, t, flags))
    expected = [
        (found(r"[!][[][^]]*][(][^)]+[)]", t), found(r"^[|].+[|]\s*\n[|][-:| ]+[|]", t, re.M), t.count("$$") // 2, found(r"^#{1,6}\s", t, re.M), found(r"[!][[][^]]*][(][^)]+[.](?i:gif|png|webp|jpe?g)[)]", t)) for t in texts
    ]
    got = counts(spark, texts)
    assert got == expected
    assert all(g[4] <= g[0] for g in got)


@pytest.mark.parametrize(
    ("md", "captions", "expected"),
    [
        ("a ![x](1.png) b ![y](2.svg) ![z](3.gif)", ["one", None], "a ![one](1.png) b ![y](2.svg) ![z](3.gif)"),
        ("![x](1.png)![x](1.png)", ["", "$1 \\ ]"], "![x](1.png)![$1 \\ ]](1.png)"),
        ("nothing", [], "nothing"),
        ("![](a.png)", ["c"], "![c](a.png)"),
    ],
)
def test_rewriting(spark, md, captions, expected):
    df = spark.createDataFrame([(md, captions)], "md string, c array<string>")
    assert df.select(markdown.rewritten(F.col("md"), F.col("c"))).first()[0] == expected


def test_newlines(spark):
    df = spark.createDataFrame([("﻿a\r\nb\rc\n\r",)], "t string")
    assert df.select(markdown.normalised_newlines(F.col("t"))).first()[0] == "﻿a\nb\nc\n\n"
