"""Name normalisation: literal names and their normal forms."""
import pytest
from pyspark.sql import functions as F

from curata.functions.rules import normalize_name

CASES = [
    (None, ""), ("", ""), ("   ", ""), ("Inc.", ""), ("OpenAI", "openai"), ("OpenAI, Inc.", "openai"),
    (" OpenAI\t", "openai"), ("OpenAI  Labs", "openai labs"), ("Stability.ai", "stability ai"),
    ("Weights & Biases", "weights biases"), ("x_y 42", "x_y 42"), ("Señor Über", "señor über"),
    ("ÑANDÚ LLC", "ñandú"), ("Acme Corp. Ltd", "acme"), ("incline", "incline"), ("café\t-\tbar", "café bar"),
]


@pytest.mark.parametrize("name,normal", CASES)
def test_normal_form(spark, name, normal):
    df = spark.createDataFrame([(name,)], "s string")
    assert df.select(normalize_name(F.col("s"))).first()[0] == normal
