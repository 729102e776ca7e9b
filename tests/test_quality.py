import pytest
from pyspark.sql import functions as F

from loamline.functions.patterns import subject_pattern
from loamline.operators import quality

ON = "The building energy model sets the ventilation and heating of each floor, and insulation keeps the concrete walls warm. "
OFF = "The poet walked along the river and spoke of love and loss, while old friends sang about the summer of their youth. "
SPARSE = OFF * 30 + "A bridge. "
GERMAN = "Das alte Lied erzählt von der Liebe und dem Leben eines jungen Mannes in der weiten Welt. "
GERMAN_ON = "Das Gebäude erhält eine neue Heizung und Dämmung, und der Beton des Tragwerks wird geprüft. "
CHINESE_ON = "建筑节能与暖通空调工程的施工结构设计混凝土"
CHINESE = "春天的花朵在阳光下静静开放他们一起唱歌跳舞"
NUMBERS = "12.5 | 33.1 | 9.99 | 1,204 ; "
CODE = "model HeatPump parameter Real temperature; equation energy = thermal * heat; end HeatPump;\n"

CASES = [(ON, 5000, False, "ok"), (ON, 150_000, True, "ok"), (OFF, 5000, False, "off-topic"), (OFF, 150_000, True, "off-topic"), (SPARSE, 150_000, False, "off-topic"), (SPARSE, 150_000, True, "off-topic"), (NUMBERS, 30_000, False, "garbage"), (NUMBERS, 150_000, True, "garbage"), (GERMAN, 10_000, False, "off-topic"), (GERMAN_ON, 10_000, False, "ok"), (CHINESE_ON, 10_000, False, "ok"), (CHINESE, 10_000, False, "off-topic"), ("a short building note", 18, False, "thin"), (CODE, 150_000, False, "ok"), ("", 0, False, "thin")]


def test_verdicts(spark):
    rows = [(i, (seed * (n // max(len(seed), 1) + 1))[:n], book) for i, (seed, n, book, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, text string, book boolean")
    df = df.withColumn("m", quality.metrics(F.col("text"))).withColumn("m", quality.whole(F.col("m")))
    got = {r["i"]: r["v"] for r in df.select("i", quality.verdict(F.col("m"), F.col("book")).alias("v")).collect()}
    assert got == {i: want for i, (_, _, _, want) in enumerate(CASES)}


def test_null_text_is_empty(spark):
    row = spark.createDataFrame([(None,)], "text string").select(quality.metrics(F.col("text")).alias("m")).first()["m"]
    assert row["total"] == 0 and row["w20"]["alpha"] == 0.0


def test_booklike(spark):
    rows = [("oer-1", "pdf", True), ("arc-1", "txt", True), ("gh-1", "txt", False), ("gh-1", "md", False), ("x", None, False)]
    df = spark.createDataFrame(rows, "id string, format string, want boolean")
    assert all(r["got"] == r["want"] for r in df.select("want", quality.is_booklike(F.col("id"), F.col("format")).alias("got")).collect())


def test_grouped_pattern_counts_as_the_plain_one(spark):
    import re

    from loamline.functions.patterns import subject_stems

    plain = "|".join((r"\b" if s[0] == "~" else "") + s.strip("~") + (r"\b" if s[-1] == "~" else "") for s in subject_stems())
    texts = [ON, OFF, GERMAN_ON, CHINESE_ON, CODE, "bimbo bim BIM ifc Byggnad obygg bygg éifc IFC", "Energyplus concrete concreto construção", " ".join(s.strip("~") for s in subject_stems())]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.regexp_count(quality.fold(F.col("t")), F.lit(subject_pattern())).alias("n"))
    assert [r["n"] for r in df.collect()] == [len(re.findall(plain, t, re.I)) for t in texts]


@pytest.mark.parametrize(("title", "off"), [("Smoking article with concrete filter", True), ("Insulated-gate bipolar transistor", True), ("IGBT drive of an air conditioner", False), ("Concrete girder", False), (None, False)])
def test_off_domain_titles(spark, title, off):
    assert spark.createDataFrame([(title,)], "t string").select(quality.off_domain_title(F.col("t"))).first()[0] == off
