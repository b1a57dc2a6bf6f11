"""The learned decision list and the classifier's gradient steps against plain Python versions."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import quality_classifier, quality_rules
from fieldbook.llm.quality_rules import BINS, FEATURES, MAX_CONDITIONS, MAX_RULES, MIN_PRECISION, MIN_SUPPORT
from fieldbook.llm.storage import Scratch


# --- quality rules ---------------------------------------------------------------------------------

def plain_list(rows):
    """Sequential covering over rows {feature: value, label, doc_id}: every condition is tried on every row."""
    def quantiles(some, f):
        own = sorted(r[f] for r in some)
        return {own[max(0, math.ceil(k / (BINS + 1) * len(own)) - 1)] for k in range(1, BINS + 1)}
    bad_rows = [r for r in rows if r["label"] == 0]
    if not bad_rows:
        return []
    cuts = {f: sorted(quantiles(rows, f) | quantiles(bad_rows, f)) for f in FEATURES}
    holds = lambda r, rule: all((r[f] >= t) == above for f, above, t in rule)
    fold = lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 3
    left, rules = rows, []
    while len(rules) < MAX_RULES:
        rule = []
        while len(rule) < MAX_CONDITIONS:
            now = [r for r in left if fold(r) and holds(r, rule)]
            bad = sum(r["label"] == 0 for r in now)
            if not bad or bad == len(now):
                break
            best, gain = None, 0.0
            for f in FEATURES:
                for t in cuts[f]:
                    for above in (True, False):
                        part = [r["label"] for r in now if (r[f] >= t) == above]
                        p = part.count(0)
                        if p >= MIN_SUPPORT and (new := p * (math.log2(p / len(part)) - math.log2(bad / len(now)))) > gain:
                            best, gain = (f, above, t), new
            if best is None or best in rule:
                break
            rule.append(best)
        if not rule:
            break
        scored = []
        for n in range(1, len(rule) + 1):
            hit = [r["label"] for r in left if not fold(r) and holds(r, rule[:n])]
            p, q = hit.count(0), hit.count(1)
            scored.append(((p - q) / (p + q) if p + q else -1.0, p, -n, q))
        _, p, n, q = max(scored)
        if p < MIN_SUPPORT or p < MIN_PRECISION * (p + q):
            break
        rules.append(rule[:-n])
        left = [r for r in left if not holds(r, rules[-1])]
    return rules


def labelled(seed, kind):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        r = {"doc_id": i} | {f: round(rng.random(), 2) for f in FEATURES}  # ties
        one = r["symbol_rate"] > 0.8
        two = r["dup_line_rate"] > 0.6 and r["digit_rate"] < 0.3
        three = r["words"] < 0.15 and r["upper_rate"] > 0.5
        bad = {"one": one, "two": one or two, "three": one or two or three, "noise": rng.random() < 0.3,
               "all good": False, "all bad": True}[kind]
        rows.append(r | {"label": int(not bad)})
    return rows


@pytest.mark.parametrize("kind", ["one", "two", "three", "noise", "all good", "all bad"])
def test_decision_list_equals_plain_covering(spark, kind):
    rows = labelled(7, kind)
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], ["doc_id", *FEATURES, "label"])
    for name in ("f", "b", "c", "bins", "any_bad", "n", "count"):
        frame = frame.withColumn(name, F.lit(name))
    rules = quality_rules.learn(frame, Scratch(spark, "rules-test"))
    assert [[(c.feature, c.above, c.threshold) for c in rule] for rule in rules] == plain_list(rows)
    assert kind not in ("one", "two", "three") or rules
    kept = {r.doc_id for r in frame.where(quality_rules.verdict(rules)).collect()}
    caught = {r["doc_id"] for r in rows if r["label"] == 0} - kept
    if kind in ("one", "two"):
        assert len(caught) >= 0.8 * sum(r["label"] == 0 for r in rows)
        assert len(kept) >= 0.97 * sum(r["label"] for r in rows)


def test_verdict_takes_the_first_rule_that_holds(spark):
    c = quality_rules.Condition
    rules = [(c("symbol_rate", True, 0.5), c("words", False, 10.0)), (c("digit_rate", True, 0.9),)]
    rows = [(1, 0.6, 5.0, 0.0), (2, 0.6, 50.0, 0.0), (3, 0.1, 5.0, 0.95), (4, 0.1, 5.0, 0.1)]
    frame = spark.createDataFrame(rows, "doc_id int, symbol_rate double, words double, digit_rate double")
    assert {r.doc_id for r in frame.where(quality_rules.verdict(rules)).collect()} == {2, 4}


# --- classifier ------------------------------------------------------------------------------------

def plain_train(rows, epochs, rate, seed):
    """The same steps with a loop per number."""
    rng = np.random.default_rng(seed)
    width = quality_classifier.WIDTH
    start = rng.uniform(-1 / width, 1 / width, (2 * quality_classifier.BUCKETS, width)).astype(np.float32)
    vectors = {b: [float(x) for x in start[b]] for at, _, _ in rows for b in at.tolist()}
    weights, bias = [[0.0, 0.0] for _ in range(width)], [0.0, 0.0]
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, n, y = rows[k]
            share = [c / sum(n.tolist()) for c in n.tolist()]
            step = rate * (1 - done / steps)
            done += 1
            mean = [sum(s * vectors[b][d] for s, b in zip(share, at.tolist(), strict=True)) for d in range(width)]
            z = [sum(mean[d] * weights[d][c] for d in range(width)) + bias[c] for c in (0, 1)]
            e = [math.exp(v - max(z)) for v in z]
            error = [e[c] / sum(e) - (c == y) for c in (0, 1)]
            back = [sum(weights[d][c] * error[c] for c in (0, 1)) for d in range(width)]
            for c in (0, 1):
                for d in range(width):
                    weights[d][c] -= step * mean[d] * error[c]
                bias[c] -= 0.1 * step * error[c]
            for s, b in zip(share, at.tolist(), strict=True):
                for d in range(width):
                    vectors[b][d] -= step * math.sqrt(s) * back[d]
    return vectors, weights, bias


def test_gradient_steps_equal_a_plain_loop():
    rng = np.random.default_rng(9)
    rows = []
    for k in range(12):
        at = np.sort(rng.choice(200, 6, replace=False)).astype(np.uint16)
        rows.append((at, rng.integers(1, 5, 6).astype(np.uint16), k % 2))
    model = quality_classifier.train(rows, epochs=3, rate=0.5, seed=4)
    vectors, weights, bias = plain_train(rows, 3, 0.5, 4)
    assert np.allclose(model.weights, weights, atol=1e-4) and np.allclose(model.bias, bias, atol=1e-4)
    assert all(np.allclose(model.vectors[b], v, atol=1e-4) for b, v in vectors.items())


def test_training_separates_two_kinds_and_repeats_itself():
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(np.arange(100) + 100 * (k % 2), 10, replace=False)).astype(np.uint16),
             np.ones(10, np.uint16), k % 2) for k in range(60)]
    one, two = quality_classifier.train(rows), quality_classifier.train(rows)
    assert all(np.array_equal(a, b) for a, b in zip(one, two, strict=True))
    for at, n, y in rows:
        share = (n / n.sum()).astype(np.float32)
        z = (share @ one.vectors[at]) @ one.weights + one.bias
        assert int(z.argmax()) == y
