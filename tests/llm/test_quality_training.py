"""Operator 5 learns from every trusted row of its half, however many a language has."""

import zlib

from cohortlab.llm import op05_quality as quality


def test_all_trusted_rows_are_learned_from(spark, monkeypatch):
    ids = range(900)
    docs = spark.createDataFrame([(i, f"word{i % 9} and some more words", "en" if i % 10 else None) for i in ids], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 50 > 0), int(i % 70 == 1)) for i in ids], "doc_id long, quality int, toxic int")
    learned, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda texts, order: (learned.append(texts.count()), train(texts, order))[1])
    assert quality.classify(docs, labels).count() == len(ids)
    want = [i for i in ids if i % 50 > 0 and i % 70 != 1 and zlib.crc32(f"train {i}".encode()) % 2 == 0]
    assert learned == [len(want)] and len(want) > 400
