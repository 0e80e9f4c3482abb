import math
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from caseweave.llm.mixing import find_exponent, mix_sources


def sized(sizes, words=10):
    """Documents of equal length; ``sizes`` says how many each source has."""
    out = []
    for source, many in sizes.items():
        out += [(len(out) + i, " ".join(["w"] * words), "en", source) for i in range(many)]
    return out


def test_repetition_limit(table):
    given = sized({"big": 400, "mid": 100, "small": 40})
    got = mix_sources(table(given), max_repeats=3.0, block_tokens=50).toPandas()
    uses = got.groupby("doc_id").size()
    assert set(uses.index) == {i for i, *_ in given}  # nothing is lost
    assert uses.max() <= 3
    per = got.groupby("source").size()
    # (400 / 40) ** (1 - exponent) is the most repeated source's number of turns.
    assert per["small"] / 40 == pytest.approx(3.0, abs=0.1)
    weights = got.groupby("source")["mix_weight"].first()
    shares = got.groupby("source")["mix_tokens"].sum() / got["mix_tokens"].sum()
    assert (weights - shares).abs().max() < 0.02


def test_budget_cuts_large_sources_by_blocks(table):
    given = sized({"big": 400, "small": 20})
    got = mix_sources(table(given), max_repeats=2.0, budget=2000, block_tokens=200).toPandas()
    tokens = got.groupby("source")["mix_tokens"].sum()
    weights = got.groupby("source")["mix_weight"].first()
    for source in ("big", "small"):
        assert tokens[source] <= weights[source] * 2000 + 1e-6
        assert tokens[source] > weights[source] * 2000 - 11  # less than one document is left over
    assert got[got["source"] == "small"].groupby("doc_id").size().max() <= 2


def test_entropy_target(spark):
    totals = spark.createDataFrame([("a", 800), ("b", 150), ("c", 50)], "key string, tokens bigint")
    exponent = find_exponent(totals, None, entropy_bits=1.3)
    raised = [x**exponent for x in (0.8, 0.15, 0.05)]
    q = [x / sum(raised) for x in raised]
    from math import log2

    assert -sum(x * log2(x) for x in q) == pytest.approx(1.3, abs=1e-6)
    assert find_exponent(totals, None, entropy_bits=5) == 0.0
    assert find_exponent(totals, None, None) == 1.0


def test_same_draw_every_time_and_order_interleaves(table):
    given = sized({"big": 300, "small": 60})
    runs = [mix_sources(table(given, parts), block_tokens=40).toPandas() for parts in (1, 5)]
    key = ["doc_id", "mix_epoch", "mix_order"]
    assert [r[key].sort_values(key).values.tolist() for r in runs][0] == runs[1][key].sort_values(key).values.tolist()
    assert runs[0]["mix_order"].between(0, 1).all()
    first = Counter(runs[0].sort_values("mix_order")["source"][:160])
    assert 0.1 < first["small"] / 160 < 0.5


def test_odd_rows(table, clashing, rows, oddities):
    assert rows(mix_sources(table([]))) == []
    given = [(i, t, None, None if i % 2 else "s") for i, t in enumerate(oddities)] + [(None, "x y", None, "s"), (3, "x")] * 2
    got = mix_sources(clashing(given))
    ids = Counter(r[0] for r in got.where(F.col("mix_epoch") == 0).select("doc_id").collect())
    assert ids == Counter(r[0] for r in given)
    blank = mix_sources(table([(1, None, None, "e"), (2, " ", None, "e")]))
    assert rows(blank, "doc_id", "mix_epoch", "mix_tokens") == [(1, 0, 0), (2, 0, 0)]


def test_plan_is_native_and_moves_no_text(table):
    plan = mix_sources(table(sized({"a": 30, "b": 3})))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan


def spark_hash(*values):
    """What xxhash64 gives for these columns: each value is hashed with the hash so far as seed."""
    found = 42
    for value in values:
        if value is not None:
            kind, number = value
            data = number.encode() if kind == "string" else number.to_bytes({"int": 4, "long": 8}[kind], "little", signed=True)
            found = xxhash.xxh64_intdigest(data, seed=found)
    return found - (1 << 64) if found >> 63 else found


def plain_mixer(docs, max_repeats, entropy_bits, budget, block_tokens, seed=42):
    """Counts of (doc_id, source, epoch), by lists and loops: blocks are sorted and taken one after the other."""
    sources = {}
    for doc_id, text, _, source in docs:
        sources.setdefault("" if source is None else "=" + source, []).append((doc_id, source, len((text or "").split())))
    tokens = {k: sum(d[2] for d in v) for k, v in sources.items()}
    whole = sum(tokens.values())
    share = {k: n / whole for k, n in tokens.items() if n}

    def spent_at(a):
        if budget is not None:
            return budget
        return sum(s**a for s in share.values()) * max(tokens[k] / s**a for k, s in share.items())

    def fits(a):
        z = sum(s**a for s in share.values())
        weights = {k: s**a / z for k, s in share.items()}
        repeats = max(weights[k] * spent_at(a) / tokens[k] for k in share)
        entropy = -sum(w * math.log2(w) for w in weights.values())
        return (max_repeats is None or repeats <= max_repeats * (1 + 1e-12)) and (
            entropy_bits is None or entropy <= entropy_bits
        )

    low, high = 0.0, 1.0
    if fits(0.0):
        high = 0.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    z = sum(s**high for s in share.values())
    draws = Counter()
    for key, members in sources.items():
        turns = share[key] ** high / z * spent_at(high) / tokens[key] + 1e-9 if tokens[key] else 1.0
        epochs = math.floor(turns)
        for epoch in range(epochs):
            draws.update((i, source, epoch) for i, source, _ in members)
        if turns - epochs <= 2e-9:
            continue
        blocks = {}
        for member in members:
            id_ = None if member[0] is None else ("long", member[0])
            block = spark_hash(id_, ("int", seed)) % (-(-tokens[key] // block_tokens) + 1)
            turn = spark_hash(id_, ("int", epochs), ("int", seed + 1))
            blocks.setdefault(block, []).append((turn, member))
        left = math.floor((turns - epochs) * tokens[key])
        order = sorted(blocks, key=lambda b: spark_hash(("string", key), ("int", b), ("int", epochs), ("int", seed)))
        for block in order:
            size = sum(m[2] for _, m in blocks[block])
            if size <= left:
                draws.update((m[0], m[1], epochs) for _, m in blocks[block])
                left -= size
                continue
            for turn in sorted({t for t, _ in blocks[block]}):  # the same id more than once goes together
                tied = [m for t, m in blocks[block] if t == turn]
                left -= sum(m[2] for m in tied)
                if left < 0:
                    break
                draws.update((m[0], m[1], epochs) for m in tied)
            break
    return draws


@pytest.mark.parametrize(
    "options",
    [
        {"max_repeats": 2.0},
        {"max_repeats": 3.7, "block_tokens": 300},
        {"max_repeats": 2.0, "budget": 9000, "block_tokens": 200},
        {"max_repeats": None, "entropy_bits": 1.2, "budget": 6000, "block_tokens": 500},
        {"max_repeats": None, "entropy_bits": 1.9, "block_tokens": 150},
    ],
)
def test_draws_equal_those_of_a_plain_mixer(table, options):
    rng = random.Random(9)
    sizes = {"hot": 420, "news": 160, "wiki": 70, None: 25, "blank": 3}
    docs = []
    for source, many in sizes.items():
        for _ in range(many):
            words = 0 if source == "blank" else rng.choice([0, 1, 5, 8, 13, 40])
            docs.append((len(docs), " ".join(["w"] * words), "en", source))
    docs += docs[5:9] * 2 + [(None, "a b c", "en", "wiki"), (None, None, None, "news"), (3, "other text", "en", "hot")]
    asked = {"max_repeats": None, "entropy_bits": None, "budget": None, "block_tokens": 1 << 20} | options
    got = Counter(tuple(r) for r in mix_sources(table(docs, 3), **asked).select("doc_id", "source", "mix_epoch").collect())
    assert got == plain_mixer(docs, **asked)
