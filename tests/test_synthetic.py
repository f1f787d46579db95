"""Values drawn from digests, against the digits they are made of."""

import base64

from pyspark.sql import functions as F

from tidemark.functions.synthetic import ALPHABET, Draw, digests


def test_mixed_text_of_its_digits(spark):
    """Base64 of a slot's last digits, with + and / replaced by two characters chosen by others."""
    rows = spark.range(200).select(digests(F.col("id"), 2).alias("d"))
    got = rows.selectExpr("d[0] AS d", f"{Draw('d', 0).mixed_text()} AS a", f"{Draw('d', 1).mixed_text()} AS b").collect()
    replaced = 0
    for row in got:
        for text, digits in ((row.a, row.d[:32]), (row.b, row.d[32:])):
            number, plain = int(digits[4:8], 16), base64.b64encode(bytes.fromhex(digits[8:])).decode()
            want = plain.replace("+", ALPHABET[number % 62]).replace("/", ALPHABET[number // 62 % 62])
            assert text == want
            replaced += text != plain
    assert replaced > 100


def test_draws_build_no_dictionary_and_walk_no_text():
    draw = Draw("d", 1)
    for made in (draw.text(), draw.mixed_text(), draw.or_null("x", 30), draw.pick(["a"])):
        assert "translate" not in made and "substring(d" not in made
