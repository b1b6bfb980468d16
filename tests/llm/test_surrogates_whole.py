from helpers import documents
from pyspark.sql import functions as F

from visitflow.llm import surrogates


def test_full_formats_and_signs_end_no_job(spark):
    texts = ["NSLog(@\"%@-%@\", a); -@-", *(f"to {k}@x now" for k in range(10)), *(f"to {chr(97 + k)}@y now" for k in range(26))]
    got = {r.doc_id: r for r in surrogates.replace_private(documents(spark, texts)).collect()}
    assert got[0].text == texts[0] and got[0].n_entities == 0
    made = [got[k].text for k in range(1, 37)]
    assert len(set(made)) == 36 and not set(made) & set(texts) and all(got[k].n_entities == 1 for k in range(1, 37))


def test_longer_surrogates_keep_all_their_places(spark):
    made = F.lit("123456789012")
    row = spark.range(1).select(surrogates._in_format(F.lit("078-05-1120"), F.lit("ssn"), made).alias("x")).first()
    assert row.x == "123-45-6789012"
