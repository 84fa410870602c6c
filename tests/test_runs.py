"""Training logs, encoding, completion and streams."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from proseframe.operators import training_log
from proseframe.operators.complete import (
    RateLimited, ServiceError, call_with_retry, complete, complete_with_fallback, fallback_from_columns,
)
from proseframe.operators.encode import encode_fixed_length, token_counts
from proseframe.sources.metric_log import read_metric_log
from proseframe.streaming import jobs

LOG = "run_id string, log_seq bigint, epoch double, step bigint, train_loss double, eval_loss double, total_time double"


def make_log(seed, runs=3, n=120):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        run = f"r{0 if rng.random() < 0.6 else rng.randrange(runs)}"
        loss = None if rng.random() < 0.3 else round(rng.choice([1.0, 2.0, 3.0]) + rng.choice([0, 0.0005, 0.2, -0.3]), 4)
        out.append((run, seq, float(seq // 40), seq * 10, rng.random(), loss, float(seq)))
    return out


def walk(log, greater=False, threshold=0.001, patience=3):
    """One row at a time: (run, seq) to (is_best, best, strikes), and the stop per run."""
    best, strikes, stop, seen = {}, {}, {}, {}
    for run, seq, _, _, _, value, _ in sorted(log, key=lambda r: r[1]):
        is_best = False
        if value is not None:
            prior = best.get(run)
            better = prior is None or (value > prior if greater else value < prior)
            far = prior is None or (better and abs(value - prior) > threshold)
            strikes[run] = 0 if far else strikes[run] + 1
            if better:
                best[run], is_best = value, True
            if strikes[run] >= patience:
                stop.setdefault(run, seq)
        seen[(run, seq)] = (is_best, best.get(run), strikes.get(run, 0))
    return seen, stop


@pytest.mark.parametrize("chunk", [1, 7, 1000])
@pytest.mark.parametrize("greater", [False, True])
def test_progress_does_not_depend_on_chunks(spark, chunk, greater):
    data = make_log(1)
    log = spark.createDataFrame(data, LOG).repartition(5)
    seen, stop = walk(data, greater)
    got = training_log.progress(log, greater_is_better=greater, chunk=chunk).collect()
    assert {(r["run_id"], r["log_seq"]): (r["is_best"], r["best_so_far"], r["strikes"]) for r in got} == seen
    only_best = training_log.running_best(log, greater_is_better=greater, chunk=chunk).collect()
    assert {(r["run_id"], r["log_seq"]): r["is_best"] for r in only_best} == {k: v[0] for k, v in seen.items()}
    stops = training_log.early_stop(log, greater_is_better=greater, chunk=chunk).collect()
    assert {r["run_id"]: r["stop_at"] for r in stops if r["stop_at"] is not None} == stop


def test_early_stop_by_hand(spark):
    values = [1.0, 0.9995, 0.5, 0.6, 0.4995, 0.55, 0.1]
    log = spark.createDataFrame([("r", i, 0.0, i, None, v, None) for i, v in enumerate(values)], LOG)
    got = training_log.early_stop(log).first()
    # 0.9995 beats by less than the threshold: one strike; 0.5 resets; then three strikes in a row
    assert (got["stop_at"], got["stop_value"], got["n_evals"]) == (5, 0.55, 7)
    assert training_log.early_stop(log, patience=4).first()["stop_at"] is None


@pytest.mark.parametrize("chunk", [3, 10_000])
def test_last_known_and_elapsed(spark, chunk):
    data = make_log(2)
    log = spark.createDataFrame(data, LOG)
    got = {r["log_seq"]: r["last_value"] for r in training_log.last_known(log, chunk=chunk).collect()}
    last = {}
    for run, seq, *_, value, _ in data:
        last[run] = value if value is not None else last.get(run)
        assert got[seq] == last[run]
    timed = log.withColumn("ts", F.timestamp_seconds(F.col("log_seq") * 2 + 1_000_000)).drop("total_time")
    for r in training_log.elapsed(timed, chunk=chunk).collect():
        first = min(s for run, s, *_ in data if run == r["run_id"])
        first_e = min(s for run, s, e, *_ in data if run == r["run_id"] and e == r["epoch"])
        assert (r["total_time"], r["epoch_time"]) == (2.0 * (r["log_seq"] - first), 2.0 * (r["log_seq"] - first_e))


def test_summary_and_checkpoints(spark):
    log = spark.createDataFrame([("r", 2, 1.0, 20, 0.5, None, 9.0), ("r", 1, 1.0, 10, 0.7, 0.3, 4.0)], LOG)
    assert tuple(training_log.training_summary(log).first()) == ("r", 2, 20, 0.5, None, 0.3, 9.0)
    paths = ["/a/checkpoint-9", "/a/checkpoint-10/", "/a/checkpoint-last", "/a/best_model", "/a/checkpoint-5-99"]
    manifest = spark.createDataFrame([("r", p) for p in paths] + [("s", "/b/checkpoint-x")], "run_id string, path string")
    assert rows(training_log.latest_checkpoint(manifest)) == [("r", "/a/checkpoint-10/", 10), ("s", "/b/checkpoint-x", 0)]


# --- encoding ---------------------------------------------------------------------


SAMPLES = [(1, "a b zz", "b"), (2, "", "a a a a a"), (3, "b b b b b", None), (4, None, "a")]


@pytest.mark.parametrize("limit", ["broadcast", "shuffle_merge"])
@pytest.mark.parametrize("side", ["right", "left"])
def test_encode(spark, limit, side):
    df = spark.createDataFrame(SAMPLES, "sample_id bigint, text string, label string").where("text is not null")
    vocabulary = spark.createDataFrame([("a", 10), ("b", 11)], "token string, token_id int")
    got = encode_fixed_length(df, vocabulary.hint(limit), max_length=4, padding_side=side)
    want = {1: ([10, 11, 1], [11]), 2: ([], [10] * 4), 3: ([11] * 4, [11] * 4)}

    def padded(ids, pad=0):
        gap = [pad] * (4 - len(ids))
        return ids + gap if side == "right" else gap + ids

    for r in token_counts(got).collect():
        ids, labels = want[r["sample_id"]]
        assert (r["input_ids"], r["labels"]) == (padded(ids), padded(labels))
        assert r["attention_mask"] == padded([1] * len(ids)) and r["n_tokens"] == len(ids)
    assert got.count() == 3


def test_encode_with_tokenizer_and_without_label(spark):
    df = spark.createDataFrame([(1, "abc")], "sample_id bigint, text string")
    got = encode_fixed_length(df, tokenizer=lambda c: F.transform(F.split(c, ""), lambda x: F.ascii(x)), max_length=2).first()
    assert got["input_ids"] == [97, 98] == got["labels"]
    with pytest.raises(ValueError):
        encode_fixed_length(df)
    with pytest.raises(ValueError):
        encode_fixed_length(df, tokenizer=lambda c: F.array(F.lit(1)), padding_side="middle")


# --- completion -------------------------------------------------------------------


def test_retry_waits():
    def failing(errors):
        left = list(errors)

        def fn(prompts):
            if left:
                raise left.pop(0)
            return [p + " ok " for p in prompts]
        return fn

    waits = []
    assert call_with_retry(failing([RateLimited(), ServiceError()]), ["p"], {}, 3, waits.append) == (["p ok"], 3, None)
    assert waits == [1, 1]
    waits.clear()
    out, attempts, error = call_with_retry(failing([TimeoutError("t")] * 3), ["p", "q"], {}, 3, waits.append)
    assert (out, attempts, error, waits) == ([None, None], 3, "TimeoutError: t", [1, 2])
    waits.clear()
    call_with_retry(failing([RateLimited()] * 3), ["p"], {}, 3, waits.append)
    assert waits == [1, 2, 4]
    assert call_with_retry(lambda prompts: [], ["p"], {}, 1, waits.append)[2].startswith("ValueError")


def test_complete_and_fallback(spark):
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(30)], "prompt_id bigint, prompt string").repartition(3)

    def even(texts, suffix=""):
        return [t + suffix if int(t[1:]) % 2 == 0 else "" for t in texts]

    def broken(texts, suffix=""):
        raise ServiceError("down")

    def small(texts, suffix=""):
        return [t.upper() if int(t[1:]) < 20 else None for t in texts]

    quiet = {"delay": 0, "sleep": lambda s: None}
    got = {r["prompt_id"]: r for r in complete(prompts, even, options={"suffix": "!"}, **quiet).collect()}
    assert got[4]["output"] == "p4!" and got[5]["output"] == "" and got[5]["provider"] == "local"
    got = {r["prompt_id"]: r for r in complete_with_fallback(prompts, [("openai", broken), ("openrouter", even), ("local", small)], **quiet).collect()}
    assert (got[2]["provider"], got[3]["provider"], got[3]["output"], got[21]["provider"]) == ("openrouter", "local", "P3", None)
    got = {r["prompt_id"]: r for r in complete_with_fallback(prompts, [("openrouter", even), ("local", small)], prefer="local", **quiet).collect()}
    assert got[2]["provider"] == "local" and got[22]["provider"] == "openrouter"
    got = {r["prompt_id"]: r for r in complete_with_fallback(prompts, {"local": small, "openrouter": even}, **quiet).collect()}
    assert got[2]["provider"] == "openrouter" and got[3]["provider"] == "local"
    failed = complete(prompts, broken, batch_size=7, **quiet).collect()
    assert all(r["output"] is None and r["attempts"] == 3 and r["error"] == "ServiceError: down" for r in failed)


def test_fallback_columns(spark):
    df = spark.createDataFrame([(None, "", "c"), ("a", "b", "c"), (None, None, "")], "x string, y string, z string")
    got = fallback_from_columns(df, ["x", "y", "z"]).select("output", "winner").collect()
    assert [tuple(r) for r in got] == [("c", "z"), ("a", "x"), (None, None)]
    assert fallback_from_columns(df, ["x", "y", "z"], prefer="y").collect()[1]["winner"] == "y"


# --- streams ----------------------------------------------------------------------


def test_stream_clean_split_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for part in range(3):
        lines = [f'{{"id": {part * 10 + i}, "text": " text  {part * 10 + i} "}}' for i in range(10)] + ['{"id": 99, "text": "  "}', "broken"]
        (source / f"f{part}.jsonl").write_text("\n".join(lines))
        stream = jobs.samples_from_json_lines(spark.readStream.text(str(source)), "text", "id")
        jobs.stream_clean_split(stream.where("reason is null").drop("reason"), out, checkpoint, once=True).awaitTermination()
    got = rows(spark.read.schema("sample_id string, text string, split string").parquet(out))
    ids = spark.range(30).select(F.col("id").cast("string").alias("sample_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    assert got == rows(jobs.clean_and_split(ids).select("sample_id", "text", "split"))


def test_stream_metrics_keep_running(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for part in range(2):
        second = '{"m": "b", "ok": false}\n' if part == 0 else '{"m": "c", "ok": true}\n'
        (source / f"f{part}.json").write_text('{"m": "a", "ok": true}\n' + second)
        stream = spark.readStream.schema("m string, ok boolean").json(str(source))
        metrics = [F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_ok")]
        jobs.stream_metrics(stream, out, checkpoint, metrics, by=["m"], once=True).awaitTermination()
    assert rows(jobs.latest_groups(spark, out, ["m"])) == [("a", 2, 2), ("b", 1, 0), ("c", 1, 1)]
    newest = spark.read.option("recursiveFileLookup", True).parquet(out).groupBy("m").agg(F.max("version").alias("v"))
    assert rows(newest) == [("a", 1), ("b", 0), ("c", 1)]  # group b did not change


def test_stream_metrics_merge_their_tables(spark, tmp_path):
    """After 20 micro-batches at most log2(20) + 1 tables stand, and they tell what a batch job does."""
    import os
    import time

    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    lines = []
    for part in range(20):
        own = [f'{{"m": "k{i}", "ok": {str((i + part) % 3 == 0).lower()}}}' for i in range(part % 7 + 1)]
        (source / f"f{part:02}.json").write_text("\n".join(own))
        os.utime(source / f"f{part:02}.json", (time.time() + part, time.time() + part))
        lines += own
    stream = spark.readStream.schema("m string, ok boolean").option("maxFilesPerTrigger", 1).json(str(source))
    metrics = [F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_ok")]
    jobs.stream_metrics(stream, out, checkpoint, metrics, by=["m"], once=True).awaitTermination()
    assert len(os.listdir(out)) <= 5
    whole = spark.read.schema("m string, ok boolean").json(str(source))
    assert rows(jobs.latest_groups(spark, out, ["m"])) == rows(whole.groupBy("m").agg(*metrics))


def test_merged_tables_follow_a_counter():
    from proseframe.streaming.jobs import _level, _merged_with

    standing: set[str] = set()
    for batch in range(300):
        standing -= set(_merged_with(batch - 1)) if batch else set()
        assert set(_merged_with(batch)) <= standing
        standing.add(f"level-{_level(batch)}-batch-{batch}")
        assert len(standing) <= (batch + 1).bit_length() + 1 and len(standing) - _level(batch) == (batch + 1).bit_count()


def test_keyed_states_equal_walk(spark, tmp_path):
    from proseframe.streaming.keyed import stream_run_states

    data = make_log(5, n=90)
    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "cp"))
    for part in range(3):
        chunk = data[part * 30 : part * 30 + 30]
        if part == 2:
            chunk = chunk + [(chunk[0][0], 0, 0.0, 0, 0.0, 0.0001, 0.0)]  # older than the state: late
        spark.createDataFrame(chunk, LOG).coalesce(1).write.mode("append").json(source)
        stream_run_states(read_metric_log(spark, source, stream=True), out, checkpoint, once=True).awaitTermination()
    got = spark.read.parquet(out).collect()
    late = [r for r in got if r["is_late"]]
    assert len(late) == 1 and late[0]["is_best"] is None and len(got) == 91 and not any(r["is_closed"] for r in got)
    seen, stop = walk(data)
    assert {(r["run_id"], r["log_seq"]): (r["is_best"], r["best_so_far"], r["strikes"]) for r in got if not r["is_late"]} == seen
    stops = {r["run_id"]: r["stop_at"] for r in sorted(got, key=lambda r: r["log_seq"]) if not r["is_late"] and r["stop_at"] is not None}
    assert stops == {k: v for k, v in stop.items() if v is not None}


def test_keyed_states_close_idle_runs(spark, tmp_path):
    import os
    import time

    from proseframe.streaming.keyed import stream_run_states

    source = tmp_path / "in"
    source.mkdir()
    minutes = [[("a", 1, 5.0, 0), ("b", 1, 3.0, 0)], [("a", 2, 4.0, 30)], [("a", 3, 4.5, 90)], [("a", 4, 4.4, 200)], [("b", 2, 9.0, 201), ("b", 3, None, 201)]]
    for i, part in enumerate(minutes):
        lines = [f'{{"run_id": "{r}", "log_seq": {q}, "eval_loss": {"null" if v is None else v}, "ts": "2024-01-01 {m // 60:02}:{m % 60:02}:00"}}' for r, q, v, m in part]
        (source / f"{i}.json").write_text("\n".join(lines))
        os.utime(source / f"{i}.json", (time.time() + i, time.time() + i))
    log = spark.readStream.schema("run_id string, log_seq bigint, eval_loss double, ts timestamp").option("maxFilesPerTrigger", 1).json(str(source))
    out = str(tmp_path / "out")
    stream_run_states(log.withWatermark("ts", "1 minute"), out, str(tmp_path / "cp"), ts="ts", idle="1 hour", once=True).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert {(r["run_id"], r["log_seq"], r["best_so_far"]) for r in got if r["is_closed"]} >= {("b", 1, 3.0)}
    again = [r for r in got if r["run_id"] == "b" and r["log_seq"] == 2 and not r["is_closed"]]
    assert len(again) == 1 and again[0]["is_best"]  # a run that comes back begins anew
    assert len([r for r in got if not r["is_closed"]]) == 7


def test_stream_running_best_over_batches_equals_walk(spark, tmp_path):
    data = make_log(4, n=90)
    source = tmp_path / "in"
    out, state, checkpoint = (str(tmp_path / p) for p in ("out", "state", "cp"))
    for part in range(3):
        chunk = data[part * 30 : part * 30 + 30]
        if part == 2:
            chunk = chunk + [(chunk[0][0], 0, 0.0, 0, 0.0, 0.0001, 0.0)]  # older than the state: late
        spark.createDataFrame(chunk, LOG).coalesce(1).write.mode("append").json(str(source))
        stream = read_metric_log(spark, str(source), stream=True)
        jobs.stream_running_best(stream, out, state, checkpoint, chunk=7, once=True).awaitTermination()
    got = spark.read.parquet(out)
    late = got.where("is_late").collect()
    assert len(late) == 1 and late[0]["is_best"] is None
    seen, stop = walk(data)
    fresh = got.where("not is_late").collect()
    assert {(r["run_id"], r["log_seq"]): (r["is_best"], r["best_so_far"], r["strikes"]) for r in fresh} == seen
    final = {r["run_id"]: r["stop_at"] for r in spark.read.parquet(f"{state}/version=2").collect()}
    assert {k: v for k, v in final.items() if v is not None} == stop


def test_encode_repeated_rows_and_tokens(spark):
    df = spark.createDataFrame([(7, "x y x", "y"), (7, "y", None), (7, None, "x"), (7, "x y x", "y")], "sample_id int, text string, label string")
    vocabulary = spark.createDataFrame([("x", 5), ("y", 6)], "token string, token_id int")
    for how in ("broadcast", "shuffle_merge"):
        got = encode_fixed_length(df, vocabulary.hint(how), max_length=3)
        assert got.count() == 4
        ids = sorted(str((r["input_ids"], r["labels"])) for r in got.collect() if any(r["input_ids"] or []))
        assert ids == sorted(["([5, 6, 5], [6, 0, 0])"] * 2 + ["([6, 0, 0], [6, 0, 0])"])
        twice = vocabulary.union(vocabulary.limit(1))
        with pytest.raises(Exception, match="more than once"):
            encode_fixed_length(df, twice.hint(how), max_length=3).collect()


def test_encode_by_blocks(spark, monkeypatch):
    """Blocks of few words, white space of every kind, other columns of any type, columns called like the operator's own."""
    import datetime
    import random

    from proseframe.operators import encode

    monkeypatch.setattr(encode, "BLOCK_WORDS", 5)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)] + ["é", "中文"]
    spaces = [" ", "\t", "\n", "\u3000", "\u0085", "\x1c", "  "]
    texts = ["".join(rng.choice(words) + rng.choice(spaces) for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, ""]
    day = datetime.datetime(2024, 1, 2, tzinfo=datetime.timezone.utc)
    df = spark.createDataFrame([(i, t, day, [i], {"k": 1.5}) for i, t in enumerate(texts)], "sample_id int, text string, at timestamp, list array<int>, map map<string, double>").repartition(3)
    vocabulary = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words[::2])], "token string, token_id int")
    known = {w: i + 2 for i, w in enumerate(words[::2])}
    with_batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        got = {r["sample_id"]: r for r in encode.lookup(df.withColumn("ids", F.col("text")), ["ids"], vocabulary, 1, 20).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_batches)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i]["ids"] == (None if t is None else [known.get(w, 1) for w in t.split()[:20]])
        assert (got[i]["text"], got[i]["list"], got[i]["map"]) == (t, [i], {"k": 1.5}) and got[i]["at"] is not None
    with pytest.raises(ValueError, match="_block"):
        encode.lookup(df.withColumn("_block", F.lit(1)), ["text"], vocabulary, 1)


def test_encode_moves_words_once_a_block(spark):
    """No text in a shuffle, no generator over the uses of words: only (block, word) rows meet the vocabulary."""
    df = spark.createDataFrame([(1, "a b a", None)], "sample_id long, text string, label string")
    vocabulary = spark.createDataFrame([("a", 10)], "token string, token_id int")
    plan = encode_fixed_length(df, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("posexplode(") == 1 and "text#" not in plan


def test_chunks_by_position_are_few(spark):
    from proseframe.operators.scans import POSITION, positioned

    sparse = spark.range(20_000).select((F.col("id") % 50).cast("string").alias("run_id"), (F.col("id") * 1_000_003).alias("log_seq"))
    table = positioned(sparse, ["run_id"], "log_seq")
    assert table.select("run_id", POSITION).distinct().count() <= 50 + table.select(POSITION).distinct().count()
    wide = positioned(spark.range(1000).select(F.lit("hot").alias("run_id"), F.col("id").alias("log_seq")).repartition(4), ["run_id"], "log_seq")
    order = [r[0] for r in wide.groupBy(POSITION).agg(F.min("log_seq").alias("m")).orderBy("m").collect()]
    assert order == sorted(order)


def test_parallel_bound_and_carried_columns(spark):
    from proseframe.operators.complete import complete

    df = spark.createDataFrame([("a", "p", 1), ("b", "q", 2)], "prompt_id string, prompt string, n int").repartition(4)
    got = complete(df, lambda prompts: [p + "!" for p in prompts], delay=0, carry=["n"], max_parallel=2)
    assert got.rdd.getNumPartitions() <= 2
    assert sorted((r["prompt_id"], r["output"], r["n"]) for r in got.collect()) == [("a", "p!", 1), ("b", "q!", 2)]


# --- completion over several runs, pacing ------------------------------------------


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.slept.append(seconds)
        self.now += seconds


def test_bucket():
    from proseframe.operators.complete import Bucket

    clock = Clock()
    bucket = Bucket(2.0, 3, clock, clock.sleep)
    for _ in range(3):
        bucket.take()
    assert clock.slept == []
    for _ in range(4):
        bucket.take()
    assert clock.now == pytest.approx(2.0) and len(clock.slept) == 4
    clock.now += 100
    for _ in range(3):
        bucket.take()
    assert len(clock.slept) == 4  # never more than a burst in store
    with pytest.raises(ValueError):
        Bucket(0)


def test_ledger_asks_nothing_twice(spark, tmp_path):
    from proseframe.operators.complete import complete_with_ledger

    log, ledger = str(tmp_path / "asked"), str(tmp_path / "ledger")

    def asked_once(broken):
        def fn(prompts):
            if any(p in broken for p in prompts if p):
                raise ValueError("broken")
            with open(log, "a") as f:
                f.writelines(f"{p}\n" for p in prompts)
            return [f"to {p}" for p in prompts]

        return fn

    prompts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, None)], "prompt_id int, prompt string")
    settings = {"delay": 0, "batch_size": 1, "max_retries": 1}
    first = complete_with_ledger(prompts, asked_once({"c"}), ledger, **settings)
    assert rows(first.select("prompt_id", F.coalesce("output", F.lit("-")), F.col("error").isNotNull())) == [
        (1, "to a", False), (2, "to b", False), (3, "to a", False), (4, "-", True), (5, "to None", False)
    ]
    more = prompts.union(spark.createDataFrame([(6, "d"), (7, "b")], prompts.schema))
    second = complete_with_ledger(more, asked_once(set()), ledger, **settings)
    assert rows(second.select("prompt_id", "output")) == [(1, "to a"), (2, "to b"), (3, "to a"), (4, "to c"), (5, "to None"), (6, "to d"), (7, "to b")]
    assert sorted(open(log).read().split()) == ["None", "a", "b", "c", "d"]
    other = complete_with_ledger(prompts, asked_once(set()), ledger, model="other", **settings)
    assert other.count() == 5 and len(open(log).read().split()) == 9  # another model has answers of its own


def test_max_parallel_bounds_calls_not_the_work_before(spark):
    from proseframe.operators.complete import complete

    prompts = spark.range(100).repartition(8).select(F.col("id").alias("prompt_id"), F.col("id").cast("string").alias("prompt"))
    done = complete(prompts, lambda p: p, max_parallel=2, rate=1e6, delay=0)
    assert done.rdd.getNumPartitions() <= 2 and done.count() == 100
    with pytest.raises(ValueError, match="max_parallel"):
        complete(prompts, lambda p: p, rate=1.0)


def test_checkpoint_folders(spark, tmp_path):
    from proseframe.sources.checkpoints import latest_checkpoint_in

    for name in ("r1/checkpoint-9", "r1/checkpoint-10", "r1/best", "r2/checkpoint-last", "r2/checkpoint-3/deep", "r2/logs"):
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / "state.json").write_text("{}")
    (tmp_path / "r1/checkpoint-99").mkdir()  # empty: nothing to resume from
    got = rows(latest_checkpoint_in(spark, str(tmp_path)).select("run_id", F.regexp_extract("path", "[^/]+$", 0), "step"))
    assert got == [("r1", "checkpoint-10", 10), ("r2", "checkpoint-3", 3)]
    with pytest.raises(ValueError, match="no checkpoints"):
        latest_checkpoint_in(spark, str(tmp_path / "r2/logs"))


def test_checkpoint_folders_are_written_and_listed_by_few_tasks(spark, tmp_path):
    from proseframe.sinks.writers import write_files
    from proseframe.sources.checkpoints import latest_checkpoint_in

    names = spark.range(300).select(F.concat(F.lit("r"), F.col("id") % 2, F.lit("/checkpoint-"), "id", F.lit("/state.json")).alias("path"), F.lit("é").alias("text"))
    write_files(names, f"file:{tmp_path}")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["r0", "r1"]
    assert (tmp_path / "r1/checkpoint-299/state.json").read_text() == "é"
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    context = spark.sparkContext
    context.setJobGroup("listing", "listing")
    found = latest_checkpoint_in(spark, str(tmp_path))
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    # each run has 150 folders: Spark by itself lists each in a task
    assert max(s.numTasks for s in stages if s) <= 4 * context.defaultParallelism
    assert rows(found.select("run_id", "step")) == [("r0", 298), ("r1", 299)]
    assert spark.conf.get(setting) == before


def test_encode_copies_the_ids_of_a_block_for_many_texts_at_once(spark, monkeypatch):
    from proseframe.operators import encode

    monkeypatch.setattr(encode, "GROUP_ROWS", 500)
    df = spark.range(3000, numPartitions=2).select("id", F.concat(F.lit("a w"), F.col("id") % 7).alias("text"))
    coded = encode._coded(df, ["text"], None)
    assert coded.where("_words is null").count() <= 8  # 3000 rows, each beside all ids of its block, before
    vocabulary = spark.range(7).select(F.concat(F.lit("w"), "id").alias("token"), (F.col("id") + 2).cast("int").alias("token_id"))
    got = encode.lookup(df, ["text"], vocabulary, 1)
    assert got.columns == ["id", "text"] and rows(got.select("id", F.col("text")[0], F.col("text")[1])) == [(i, 1, i % 7 + 2) for i in range(3000)]
    monkeypatch.setattr(encode, "GROUP_CODES", 100)
    assert encode._coded(df, ["text"], None).where("_words is null").count() >= 60


def test_quarantine_lines_come_in_three_batches_of_as_many_files_as_the_table_needs(spark, sf, monkeypatch, tmp_path):
    from proseframe.plans import catalogue

    monkeypatch.setattr(catalogue, "shared_dir", lambda _, name: str(tmp_path / name))
    want = {r["reason"]: r["n_rows"] for r in catalogue.stream_jsonl_quarantine(spark, sf).collect()}
    settings = {"spark.sql.files.maxPartitionBytes": "150000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    monkeypatch.setattr(catalogue, "shared_dir", lambda _, name: str(tmp_path / "small" / name))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = {r["reason"]: r["n_rows"] for r in catalogue.stream_jsonl_quarantine(spark, sf).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want
    assert len(list((tmp_path / "small/stream-lines").glob("part-*"))) > 3
    assert sorted(p.name for p in (tmp_path / "small/stream-out").glob("batch=*")) == ["batch=0", "batch=1", "batch=2"]


def test_run_states_read_as_many_files_a_batch_as_the_log_needs(spark, sf, monkeypatch, tmp_path):
    from proseframe.plans import catalogue

    monkeypatch.setattr(catalogue, "shared_dir", lambda _, name: str(tmp_path / name))
    want = rows(catalogue.stream_run_states(spark, sf).select(F.to_json(F.struct("*"))))
    settings = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    monkeypatch.setattr(catalogue, "shared_dir", lambda _, name: str(tmp_path / "small" / name))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = catalogue.stream_run_states(spark, sf).select(F.to_json(F.struct("*")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rows(got) == want
    files = len(list((tmp_path / "small/stream-log").glob("part-*")))
    assert files > 4 and files % 4 == 0
