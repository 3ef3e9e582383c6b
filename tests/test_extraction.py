import json
import random

import pytest
from pyspark.sql import functions as F

from folioflow.functions import contract
from folioflow.functions.contract import FIELDS, reply_error
from folioflow.operators import jobs as J


def reply(**changes):
    base = {f: {"value": "v", "source_span": [{"page": 1, "text": "t"}], "confidence": 0.5} for f in FIELDS}
    return base | changes


def item(**k):
    return {"value": "v", "source_span": [], "confidence": 0.5} | k


GOOD = [reply(), reply(problem_gap=item(confidence=0)), reply(problem_gap=item(value=None, confidence=0.0)), reply(problem_gap=item(source_span=[{"page": None, "text": " "}])), reply(problem_gap=item(confidence=1))]
BAD = [
    (reply(problem_gap="x"), "problem_gap must be an object"), (reply(problem_gap={"value": None}), "keys must be exactly"), (reply(problem_gap=item(value=" ")), "null or a non-empty"),
    (reply(problem_gap=item(value=3)), "null or a non-empty"), (reply(problem_gap=item(source_span={})), "must be a list"), (reply(problem_gap=item(source_span=[{"page": 1, "text": "t"}] * 4)), "at most 3"),
    (reply(problem_gap=item(confidence=True)), "numeric"), (reply(problem_gap=item(confidence="0.5")), "numeric"), (reply(problem_gap=item(confidence=1.1)), "between"), (reply(problem_gap=item(confidence=float("nan"))), "between"),
    (reply(problem_gap=item(value=None, source_span=[{"page": 1, "text": "t"}], confidence=0)), "empty source_span"), (reply(problem_gap=item(value=None, confidence=0.1)), "confidence 0.0"),
    (reply(problem_gap=item(source_span=[{"page": 1}])), "exactly page and text"), (reply(problem_gap=item(source_span=[{"page": 3.0, "text": "t"}])), "integer or null"),
    (reply(problem_gap=item(source_span=[{"page": True, "text": "t"}])), "integer or null"), (reply(problem_gap=item(source_span=[{"page": 1, "text": ""}])), "non-empty string"), (reply(extra=1), "extra=['extra']"), ([], "must be a JSON object"),
]


@pytest.mark.parametrize("payload", GOOD)
def test_accepted(payload):
    assert reply_error(json.dumps(payload)) is None


@pytest.mark.parametrize("payload, message", BAD)
def test_refused(payload, message):
    assert message in reply_error(json.dumps(payload))


def test_what_is_no_json():
    good = json.dumps(reply())
    assert reply_error(good + " x") and reply_error("```json\n" + good + "```") and reply_error(None) and reply_error("")
    assert reply_error(good[:-1] + ', "problem_gap": ' + json.dumps(item()) + "}") is None  # the last of two keys counts


def test_on_columns(spark):
    df = spark.createDataFrame([(json.dumps(reply()),), ("{}",), (None,)], "raw string").withColumn("e", contract.contract_error("raw"))
    rows = df.select("e", contract.parsed(F.col("raw"), F.col("e")).alias("r")).collect()
    assert rows[0].e is None and rows[0].r.problem_gap.source_span[0].page == 1
    assert rows[1].r is None and rows[2].r is None and rows[2].e


@pytest.mark.parametrize("spec, total, want", [("5", 10, (1, 5)), ("5-20", 10, (5, 10)), (" 5 - 7 ", 10, (5, 7)), (None, 4, (1, 4))])
def test_limits(spec, total, want):
    assert J.parse_limit(spec, total) == want


@pytest.mark.parametrize("spec", ["0", "9-3", "11-12", "x", "-3", "1-"])
def test_bad_limits(spec):
    with pytest.raises(ValueError):
        J.parse_limit(spec, 10)


def test_errors_are_classified(spark):
    rows = [(429, None, None), (408, "X", "too many requests"), (503, None, None), (400, "X", "bad"), (None, "ReadTimeout", ""), (None, "X", "Throttled by peer"), (None, "ConnectionError", "429"), (None, "ValueError", "nope"), (None, None, None)]
    df = spark.createDataFrame(rows, "s int, t string, m string").select(J.classify_error(F.col("s"), F.col("t"), F.col("m")).alias("k"))
    assert [tuple(r.k) for r in df.collect()] == [(True, True), (True, False), (True, False), (False, False), (True, False), (True, True), (True, True), (False, False), (False, False)]


def test_concurrency_against_a_loop(spark):
    rng = random.Random(4)
    rows = [(run, n, rng.random() < 0.9, int(rng.random() < 0.05)) for run in range(5) for n in range(1500 if run == 2 else 200)]
    got = {(r.run, r.n): r.current for r in J.aimd(spark.createDataFrame(rows, "run int, n int, success boolean, throttles int"), "run", "n").collect()}
    for run in range(5):
        cur, clean = 8, 0
        for _, n, ok, slow in (r for r in rows if r[0] == run):
            if slow:
                cur, clean = max(2, int(max(2, cur * 0.7))), 0
            elif ok:
                clean += 1
                if clean >= 8:
                    cur, clean = min(24, cur + 1), 0
            else:
                clean = 0
            assert got[run, n] == cur


def test_jobs_from_files(spark):
    paths = ["a/p.10/llm_context.txt", "a/p.2/llm_context.py", "a/p.2/llm_context.txt", "a/p.2/visuals/z10.PNG", "a/p.2/visuals/z9.jpg", "a/p.2/visuals/n.txt", "a/p.10/Visuals/a.png", "a/p.10/visuals/b.png", "a/empty/readme.md"]
    got = {r.paper_id: (r.position, r.context_path, r.image_paths) for r in J.discover_jobs(spark.createDataFrame([(p,) for p in paths], "path string")).collect()}
    assert got == {"p.2": (1, "a/p.2/llm_context.txt", ["a/p.2/visuals/z9.jpg", "a/p.2/visuals/z10.PNG"]), "p.10": (2, "a/p.10/llm_context.txt", ["a/p.10/Visuals/a.png"])}


def test_model_calls(spark):
    good = json.dumps(reply())

    def make_client():
        seen = {}

        def client(context, prompt):
            seen[context] = seen.get(context, 0) + 1
            if context == "slow":
                raise TimeoutError("timed out")
            if context == "never" or context == "second" and seen[context] == 1:
                return "no json"
            return good

        return client

    df = spark.createDataFrame([("a", 1, "fine"), ("b", 2, "second"), ("c", 3, "never"), ("d", 4, "slow")], "paper_id string, position int, context string")
    got = {r.paper_id: (r.status, r.client_calls, r.error_type, r.retryable_at_failure) for r in J.run_jobs(df, make_client, "p").collect()}
    assert got == {"a": ("success", 1, None, None), "b": ("success", 2, None, None), "c": ("failed", 2, "ValueError", False), "d": ("failed", 1, "TimeoutError", True)}


def test_resuming_twice_leaves_nothing(spark):
    jobs = spark.createDataFrame([(1, "a"), (2, "b")], "position int, paper_id string")
    results = spark.createDataFrame([("a", "failed"), ("b", "success"), ("b", "failed"), (None, "success")], "paper_id string, status string")
    assert [r.paper_id for r in J.resume(jobs, results).collect()] == ["a"]
    assert J.resume(jobs, results.unionByName(spark.createDataFrame([("a", "success")], results.schema))).count() == 0
