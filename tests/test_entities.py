from pyspark.sql import functions as F

from corpusmill.operators import entities


def test_tokens_and_sentences(spark):
    df = spark.createDataFrame([("لبست كوفية، اليوم. قصير جدا\nجملة من ثلاث",)], "t string")
    assert df.select(entities.sentences(F.col("t"))).first()[0] == ["لبست كوفية، اليوم", "جملة من ثلاث"]
    assert df.select(entities.tokens(F.lit("لبست كوفية، x_1"))).first()[0] == ["لبست", "كوفية", "،", "x_1"]


def test_tagger(spark):
    def tagger(sentences):
        return [["B-PERS" if t == "محمد" else "I-PERS" if t == "علي" else "O" for t in s] for s in sentences]

    df = spark.createDataFrame([(0, "أكل محمد علي المسخن اليوم"), (1, "أكل محمد علي المسخن اليوم"), (2, None)], "n int, text string")
    found = {r.n: [tuple(e) for e in r.entities] for r in entities.with_entities(df, tagger).collect()}
    wanted = [("المسخن", "PAL_FOOD", "heritage_dict"), ("محمد علي", "PERS", "camel_ner")]
    assert found == {0: wanted, 1: wanted, 2: []}
    first = {r.n: len(r.entities) for r in entities.with_entities(df, tagger, limit=1, order="n").collect()}
    assert first == {0: 2, 1: 0, 2: 0}


def test_dictionary_size():
    assert len(entities.DICTIONARY) == 82


def test_no_conjunction_cut():
    assert entities.merged(["وسعيد"], ["B-PERS"], [False], strip=False) == [("وسعيد", "PERS", "camel_ner")]
    assert entities.merged(["و", "من"], ["B-X", "O"], [False, False]) == [("و", "X", "camel_ner")]
