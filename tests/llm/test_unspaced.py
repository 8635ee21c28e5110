"""Order MinHash of texts with few blanks."""

import random

from pyspark.sql import functions as F

from rewardlake.llm import order_minhash


def test_one_insertion(spark):
    """One character more near the start; and texts about sixteen code points a word, just over and just under."""
    rng = random.Random(9)
    chinese = "".join(chr(0x4E00 + rng.randrange(3_000)) for _ in range(1_500))
    encoded = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefgh0123456789+/", k=4_000))
    mixed = [" ".join("".join(rng.choices("abcdefghij", k=n)) for n in [17, 16] * 150) for _ in range(2)]
    pairs = [(chinese, chinese[:5] + "好" + chinese[5:]), (encoded, encoded[:3] + "=" + encoded[3:]),
             (mixed[0] + " ab" * 2, mixed[0] + " abcdefghijklmnopqrstuvwxyz" * 30), (chinese, chinese[::-1]), (mixed[0], mixed[1])]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    df = order_minhash.with_fingerprint(order_minhash.with_fingerprint(df, "a", "f"), "b", "g")
    like = {r["i"]: r["x"] for r in df.select("i", order_minhash.likeness(F.col("f"), F.col("g")).alias("x")).collect()}
    assert min(like[0], like[1]) > 0.8 and like[2] > 0.3 and max(like[3], like[4]) < 0.1
