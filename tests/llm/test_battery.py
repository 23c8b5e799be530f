"""The randomness battery: its p-values against a plain statement of the tests, its error on random strings."""
import math
import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuora.llm import secret_scan
from valuora.llm import spans as S

ALPHABETS = {16: "0123456789ABCDEF", 32: "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 36: string.digits + string.ascii_lowercase,
             62: string.digits + string.ascii_uppercase + string.ascii_lowercase,
             64: string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"}
erfc = np.vectorize(math.erfc)


def battery(v, k):
    """Combined p-value of each row of letters ``v`` over an alphabet of ``k``."""
    n = v.shape[1]
    x2 = k / n * sum((v == c).sum(axis=1) ** 2.0 for c in range(k)) - n
    sd = math.sqrt(2 * (k - 1) * (1 - 1 / n))
    skew = 4 * (n - 1) * (k - 1) * (k + 2 * n - 6) / n ** 2 / sd ** 3
    shape = 4 / skew ** 2
    z = (np.cbrt(np.maximum(1 + (x2 - k + 1) / sd / math.sqrt(shape), 0)) - 1 + 1 / (9 * shape)) * 3 * math.sqrt(shape)
    u = 2 * v - (k - 1.0)
    runs = (np.sign(u[:, 1:]) * np.sign(u[:, :-1])).sum(axis=1) / math.sqrt(n - 1)
    serial = (u[:, 1:] * u[:, :-1]).sum(axis=1) / ((k * k - 1) / 3) / math.sqrt(n - 1)
    rho = 0.75 * k * k / (k * k - 1)
    rest = (serial - rho * runs) / math.sqrt(1 - rho ** 2)
    h = -sum(np.log(np.maximum(p, 1e-290)) for p in (
        0.5 * erfc(z / math.sqrt(2)), erfc(abs(runs) / math.sqrt(2)), erfc(abs(rest) / math.sqrt(2))))
    low = h - np.log(1 + h + h * h / 2)
    return np.exp(-low * (1 + secret_scan.LIFT * (20 / n) ** 0.75 * low * low) ** (-1 / 6))


def test_p_values_are_the_plain_ones(spark):
    rng = random.Random(4)
    rows = []
    for k, abc in ALPHABETS.items():
        for n in (20, 21, 33, 90):
            words = ["".join(rng.choice(abc) for _ in range(n)) for _ in range(12)]
            words += [(abc[:5] + abc[-5:]) * (n // 10) + abc[-2:] + abc[:n % 10], "".join(sorted(words[0]))]
            must = {32: r"[A-Z2-7]+", 16: r"[0-9A-F]+"}
            rows += [(k, w) for w in words if k not in must or not w.isalpha()]
    made = spark.createDataFrame(rows, "k int, w string").withColumn("runs", S.matches(F.col("w"), secret_scan.RUN))
    kinds = {16: "[0-9A-F]+", 32: "[A-Z2-7]+", 36: "[0-9a-z]+|[0-9A-Z]+", 62: "[0-9A-Za-z]+", 64: ".+"}
    got = made.withColumn("t", F.expr(secret_scan.tested("runs"))).select("w", "t").distinct().collect()
    seen = set()
    for w, t in ((r.w, r.t) for r in got):
        if not t:
            continue
        k = next(k for k, rx in kinds.items() if re.fullmatch(rx, w) and (k != 16 or re.fullmatch("[0-9a-f]+|[0-9A-F]+", w)))
        abc = ALPHABETS[k]
        v = np.array([[(abc if k != 62 else ALPHABETS[62]).index(c.lower() if k == 36 else c) for c in w]])
        want = battery(v, k)[0]
        assert abs(math.log(t[0].p) - math.log(want)) < 1e-2 + 0.05 * max(0.0, -math.log(want) - 12), (k, w)
        seen.add(k)
    assert seen == set(ALPHABETS)


@pytest.mark.parametrize("k", sorted(ALPHABETS))
def test_share_of_random_strings_dismissed(k):
    """At or below p lie p of the random strings: within 1.2 times and three standard errors."""
    rng = np.random.default_rng(k)
    for n in (20, 24, 32, 64, 128):
        p = battery(rng.integers(0, k, (100_000, n), dtype=np.int16), k)
        for level in (0.05, 0.01, 0.001):
            assert (p <= level).mean() <= 1.2 * level + 3 * math.sqrt(level / len(p)), (n, level)
            assert (p <= level).mean() >= 0.7 * level - 3 * math.sqrt(level / len(p)), (n, level)


def test_precision_and_recall_of_planted_keys(spark):
    """Thousands of documents, keys and structured runs among the words: what the battery reports."""
    rng = random.Random(8)
    keys, names = {}, {}
    rows = []
    for i in range(3000):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(12)]
        if i % 3 == 0:
            k = rng.choice([32, 62, 64])
            keys[i] = "".join(rng.choice(ALPHABETS[k]) for _ in range(rng.choice([24, 32, 40, 64]))) + ("7KQ2" if k == 32 else "7aK2")
            words[5] = keys[i]
        elif i % 3 == 1:
            piece = rng.choice(["Version1", "build2A", "Ab12", "xY9"])
            names[i] = (piece * 20)[:rng.choice([28, 36, 48])]
            words[7] = names[i]
        rows.append((i, " ".join(words)))
    out = {r.doc_id: any(x.kind == "random" for x in r.spans) for r in secret_scan.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = sum(out[i] for i in keys)
    wrong = sum(out[i] for i in out if i not in keys)
    assert hit >= 0.94 * len(keys)                 # ALPHA of them may go
    assert hit >= 0.99 * (hit + wrong)
