"""One query per operator over the test tables; `oracles` holds the SQL each must agree with."""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.distilled import distil, word_buckets
from freshet.functions.lexicon import NeedsLexicon, SentimentLexicon
from freshet.functions.models import SENTIMENT, USER_NEEDS
from freshet.functions.payload import bytes_text, payload_json, prompt_messages
from freshet.functions.times import iso_timestamp
from freshet.operators import joins, sampling
from freshet.operators.profile import result_profile
from freshet.operators.projection import project_exclude, project_include, recent_first
from freshet.operators.responses import flatten, parse_responses, valid_rows
from freshet.operators.scoring import RateLimited, Retry, score_with
from freshet.operators.sizing import spread_small
from freshet.operators.state import incremental_filter, last_processed
from freshet.operators.waves import REQUEST, RunFolder, ask_in_waves, request_id
from freshet.plans import views
from freshet.plans.jobs import Completer, Job, Native, run_job, select_rows
from freshet.session import scratch_dir
from freshet.sinks.target import Target
from freshet.sources.scan import Source, relative_cutoff, scan_window
from freshet.streaming.backlog import Backlog, work_off
from freshet.streaming.stream import start_stream

CUTOFF = datetime(2024, 1, 3)
LATE_CUTOFF = datetime(2024, 1, 5)
FIRST_RUN = datetime(2024, 1, 16)
SECOND_RUN = datetime(2024, 1, 31)
WHOLE_MONTH = 720
SEED = 7

# Frequent words of the test documents, in arbitrary roles.
SENTIMENT_WORDS = SentimentLexicon(positive=("the", "that", "with"), negative=("and", "for", "was"))
NEEDS_WORDS = NeedsLexicon(
    {
        "wissen": (("the", "der"), ("and", "und")),
        "verstehen": (("of", "in", "de"), ("to", "la")),
        "fuehlen": (("with", "for"), ("that", "le")),
        "machen": (("is", "on"), ("was", "are", "el")),
    }
)

# A small limit, so that keys do get split at test size.
TEST_HOT_ROWS = 20


# Scans


def scan_window_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_window(views.reactions(spark, sf_dir), "last_update_time", CUTOFF)


def scan_relative_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    reactions = views.reactions(spark, sf_dir)
    cutoff = relative_cutoff(reactions, "last_update_time", 48)
    return scan_window(reactions, "last_update_time", cutoff)


def _source(df: DataFrame, *row_id: str) -> Source:
    return Source(key="post_key", ts="last_update_time", frame=df, row_id=row_id)


def _target(spark: SparkSession, **options) -> Target:
    return Target(key="post_key", ts="written_at", path=scratch_dir(spark, "target"), **options)


def multi_source_empty_cold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing processed yet: the source without rows in the window is left out."""
    job = Job(
        sources=(
            _source(views.quality_stale(spark, sf_dir)),
            _source(views.posts(spark, sf_dir)),
            _source(views.reactions(spark, sf_dir)),
        ),
        target=_target(spark),
        model=SENTIMENT,
    )
    rows = select_rows(spark, job, LATE_CUTOFF)
    return rows.select("post_key", "n_chars", "event_id", F.col("last_update_time").alias("reacted_at"))


def multi_source_empty_warm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With state, the same source empties the read; the other two alone give rows."""
    target = _target(spark)
    done = views.processed(spark, sf_dir).groupBy("post_key").count()
    target.append(done, LATE_CUTOFF)
    posts, reactions = _source(views.posts(spark, sf_dir)), _source(views.reactions(spark, sf_dir))

    def counted(label: str, *sources: Source) -> DataFrame:
        rows = select_rows(spark, Job(sources=sources, target=target, model=SENTIMENT), LATE_CUTOFF)
        if rows is None:
            rows = spark.range(0)
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("sources"), "n")

    stale = _source(views.quality_stale(spark, sf_dir))
    return counted("all", stale, posts, reactions).union(counted("without the empty one", posts, reactions))


def state_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target of two runs, partitioned by month, read from a cut-off between them."""
    target = _target(spark, partition_by="month")
    done = views.processed(spark, sf_dir)
    first = done.groupBy("post_key").agg(F.min(F.hour("written_at")).alias("hour"))
    second = done.groupBy("post_key").agg(F.max(F.hour("written_at")).alias("hour"))
    target.append(first, datetime(2023, 11, 30, 23, 30))
    target.append(second, FIRST_RUN)
    return target.load(spark, CUTOFF).select("post_key", "hour", "written_at")


def adhoc_inner_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, reactions = views.posts(spark, sf_dir), views.reactions(spark, sf_dir)
    joined = joins.adhoc_inner(posts, reactions, "post_key", "last_update_time", CUTOFF)
    return joined.drop("post_message")


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.posts(spark, sf_dir).createOrReplaceTempView("freshet_adhoc_posts")
    views.reactions(spark, sf_dir).createOrReplaceTempView("freshet_adhoc_reactions")
    return spark.sql(
        """
        SELECT p.post_key, p.last_update_time AS posted_at, p.post_type, p.lang, p.n_chars,
               r.event_id, r.last_update_time AS reacted_at, r.event_type, r.value
        FROM freshet_adhoc_reactions r JOIN freshet_adhoc_posts p ON r.post_key = p.post_key
        WHERE r.last_update_time >= TIMESTAMP_NTZ '2024-01-31 00:00:00' - INTERVAL '672' HOUR
          AND p.last_update_time >= TIMESTAMP_NTZ '2024-01-31 00:00:00' - INTERVAL '672' HOUR
        """
    )


# State and the incremental filter


def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_processed(views.processed(spark, sf_dir), "post_key", "written_at", "latest")


def state_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_processed(views.processed(spark, sf_dir), "post_key", "written_at", "oldest")


def state_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The times kept beside a target of two runs, without a look at its rows."""
    target = _target(spark, runs=scratch_dir(spark, "runs"), keep_state=True)
    posts = views.posts(spark, sf_dir).select("post_key", "post_type")
    target.append(posts, FIRST_RUN)
    target.append(posts.filter(F.col("post_key") % 3 == 0), SECOND_RUN)
    return target.state(spark)


def incremental_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_filter(
        views.reactions(spark, sf_dir), state_latest(spark, sf_dir), "post_key", "last_update_time"
    )


def incremental_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_filter(
        views.reactions(spark, sf_dir), state_oldest(spark, sf_dir), "post_key", "last_update_time"
    )


def incremental_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = last_processed(views.processed_nullkey(spark, sf_dir), "post_key", "written_at")
    return incremental_filter(views.reactions(spark, sf_dir), state, "post_key", "last_update_time")


def _large_state(**options) -> Callable[[SparkSession, str], DataFrame]:
    """`incremental_null_key`, done as for a state too large to broadcast."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        state = last_processed(views.processed_nullkey(spark, sf_dir), "post_key", "written_at")
        reactions = views.reactions(spark, sf_dir)
        return incremental_filter(reactions, state, "post_key", "last_update_time", large=True, **options)

    return query


# Joins


def _without_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.posts(spark, sf_dir).drop("post_message")


def join_left_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_sources([_without_text(spark, sf_dir), views.reactions(spark, sf_dir)], "post_key")


def join_left_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [_without_text(spark, sf_dir), views.reactions(spark, sf_dir), views.quality(spark, sf_dir)]
    return joins.join_sources(frames, "post_key")


def join_left_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`join_left_three`, from the side with null keys, joined as for sources too large to
    broadcast."""
    frames = [views.reactions(spark, sf_dir), _without_text(spark, sf_dir), views.quality(spark, sf_dir)]
    return joins.join_sources(frames, "post_key", hot_rows=TEST_HOT_ROWS, large=True)


def join_salted_both_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reaction with an even id beside the counts, by type, of its post's odd ones: hot on either
    side, and linear in the reactions."""
    reactions = views.reactions(spark, sf_dir)
    odd = F.col("event_id") % 2 == 1
    evens = reactions.filter(~odd).select("post_key", "event_id")
    odds = reactions.filter(odd).groupBy("post_key", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return joins.join_sources([evens, odds], "post_key", hot_rows=3, large=True)


def join_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [views.reactions(spark, sf_dir), _without_text(spark, sf_dir)]
    return joins.join_sources(frames, "post_key", prefer="right")


# Projection, order, samples


def project_include_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_include(views.posts(spark, sf_dir), ["post_message", "post_key", "no_such_column"])


def project_exclude_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_exclude(views.posts(spark, sf_dir), ["post_message", "n_chars", "no_such_column"])


def recent_first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_first(views.reactions(spark, sf_dir), "last_update_time", "event_id").limit(100)


def _joined_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_left_two(spark, sf_dir).select("post_key", "event_id", "post_type", "event_type")


def sample_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_exact(_joined_ids(spark, sf_dir), 500, ["post_key", "event_id"], SEED)


def sample_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_exact(_joined_ids(spark, sf_dir), 10_400, ["post_key", "event_id"], SEED)


def sample_overask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_exact(_joined_ids(spark, sf_dir), 100_000_000, ["post_key", "event_id"], SEED)


def sample_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows is up to chance; how many, and that none comes twice, is not."""
    drawn = sampling.sample_random(views.reactions(spark, sf_dir), 500, ["event_id"])
    return drawn.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_distinct"))


# Payloads


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small(views.posts(spark, sf_dir))


def fmt_iso_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.events(spark, sf_dir).select(F.col("event_id").alias("id"), "ts")
    posts = views.posts(spark, sf_dir).select(F.col("post_key").alias("id"), F.col("last_update_time").alias("ts"))
    return events.union(posts).select("id", iso_timestamp(F.col("ts")).alias("iso"))


def fmt_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.col("post_message").cast("binary")
    return views.posts(spark, sf_dir).select("post_key", bytes_text(message).alias("message"))


def payload_json_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    reactions = views.reactions(spark, sf_dir)
    return reactions.select("event_id", payload_json(reactions).alias("payload"))


def payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _texts(spark, sf_dir)
    return posts.select("post_key", payload_json(posts, ["post_message", "lang"]).alias("payload"))


def prompt_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = views.posts(spark, sf_dir)
    messages = prompt_messages(SENTIMENT.prompt, payload_json(posts, ["post_key", "post_type"]))
    return posts.select("post_key", F.explode(messages).alias("m")).select("post_key", "m.role", "m.content")


# Answers


def response_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every answer with its result or the reason it is rejected."""
    return parse_responses(spread_small(views.answers(spark, sf_dir)), SENTIMENT, error="error")


def response_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(response_parse(spark, sf_dir))


def response_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = response_parse(spark, sf_dir).filter(F.col("reject_reason").isNotNull())
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def response_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = response_parse(spark, sf_dir).filter(F.col("reject_reason") == "domain")
    return rejects.select("event_id", "reject_reason")


def flatten_user_needs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested answers as JSON text, parsed and flattened."""
    posts = _texts(spark, sf_dir)
    answers = posts.select("post_key", F.to_json(NEEDS_WORDS(F.col("post_message"))).alias("content"))
    return parse_responses(answers, USER_NEEDS)


# Scoring


def enrich_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _texts(spark, sf_dir)
    return flatten(posts.select("post_key", SENTIMENT_WORDS(F.col("post_message")).alias("a")), "a", SENTIMENT)


def enrich_user_needs(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _texts(spark, sf_dir)
    return flatten(posts.select("post_key", NEEDS_WORDS(F.col("post_message")).alias("a")), "a", USER_NEEDS)


def rule_completer(prompt: str, payload: str) -> str:
    """A reproducible stand-in for a model: judges by the length, fails on some posts."""
    post = json.loads(payload)
    length = post["n_chars"]
    if length % 11 == 0:
        raise RuntimeError("refused")
    if length % 13 == 0:
        return "sorry, no"
    if length % 7 == 0:
        return ""
    score = (length % 201 - 100) / 100
    sentiment = "positive" if score > 0 else "negative" if score < 0 else "neutral"
    return json.dumps({"score": score, "sentiment": sentiment, "confidence": 0.5, "type": post["post_type"]})


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _texts(spark, sf_dir)
    asked = posts.select("post_key", payload_json(posts, ["post_type", "post_message", "n_chars"]).alias("payload"))
    return parse_responses(score_with(asked, rule_completer, SENTIMENT.prompt, workers=4), SENTIMENT, error="error")


def late_completer(prompt: str, payload: str) -> str:
    """`rule_completer`, for posts it has not been asked about before."""
    if json.loads(payload)["post_key"] % 3 == 0:
        return "asked again"
    return rule_completer(prompt, payload)


def score_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the posts answered by a run that went no further; the run taken up for all of them."""
    folder = RunFolder(spark, scratch_dir(spark, "run"))

    def requests() -> DataFrame:
        posts = _texts(spark, sf_dir)
        payload = payload_json(posts, ["post_key", "post_type", "n_chars"])
        asked = posts.select("post_key", payload.alias("payload"))
        return asked.withColumn(REQUEST, request_id(asked, ["post_key"], "payload"))

    asked = folder.once("requests", requests)
    options = {"folder": folder, "workers": 4}
    ask_in_waves(asked.filter(F.col("post_key") % 3 == 0), rule_completer, SENTIMENT.prompt, **options)
    answered = ask_in_waves(folder.once("requests", requests), late_completer, SENTIMENT.prompt, **options)
    return parse_responses(answered, SENTIMENT, error="error")


def busy_completer() -> Callable[[str, str], str]:
    """A model that is busy up to six times, as often as the post's length says."""
    tries = Counter()

    def complete(prompt: str, payload: str) -> str:
        post = json.loads(payload)
        tries[post["post_key"]] += 1
        if tries[post["post_key"]] <= post["n_chars"] % 7:
            raise RateLimited("busy")
        return f"after {tries[post['post_key']]}"

    return complete


def score_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a busy model answers at the first to fifth attempt, or not at all."""
    posts = views.posts(spark, sf_dir)
    asked = posts.select("post_key", payload_json(posts, ["post_key", "n_chars"]).alias("payload"))
    return score_with(asked, busy_completer(), SENTIMENT.prompt, workers=4, retry=Retry(sleep=lambda _: None))


def echo_completer(prompt: str, payload: str) -> str:
    return payload


def score_keeps_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with null and repeated keys come back with their own key and answer."""
    reactions = views.reactions(spark, sf_dir)
    asked = reactions.select("post_key", "event_id", payload_json(reactions, ["event_id", "event_type"]).alias("payload"))
    return score_with(asked, echo_completer, SENTIMENT.prompt, workers=4).drop("error")


def enrich_distilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer learned from the answers to every third post, for all of them: the words it goes by, and
    whether it gives an answer of the model's form."""
    posts = _texts(spark, sf_dir)
    answered = posts.filter(F.col("post_key") % 3 == 0)
    answers = flatten(answered.select("post_message", SENTIMENT_WORDS(F.col("post_message")).alias("a")), "a", SENTIMENT)
    scorer = distil(answers, "post_message", SENTIMENT)
    scored = flatten(posts.select("post_key", "post_message", scorer(F.col("post_message")).alias("a")), "a", SENTIMENT)
    known = F.col("sentiment").isin(*next(f.allowed for f in SENTIMENT.fields if f.allowed))
    return scored.select(
        "post_key", F.size(word_buckets(F.col("post_message"))).cast("long").alias("n_words"),
        (known & F.col("score").isNotNull() & F.col("confidence").isNotNull()).alias("answered"),
    )


# Target


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_sentiment(spark, sf_dir).select("score", "sentiment", "confidence", "post_key")


def write_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, partition_by="month")
    target.append(_batch(spark, sf_dir), FIRST_RUN)
    target.append(_batch(spark, sf_dir).select("post_key", "confidence", "score", "sentiment"), SECOND_RUN)
    return target.load(spark)


def write_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, the same run once more, and one that wrote its rows but was lost before its commit."""
    target = _target(spark, partition_by="month", runs=scratch_dir(spark, "runs"))
    batch = _batch(spark, sf_dir)
    target.append(batch, FIRST_RUN, "first")
    target.append(batch, SECOND_RUN, "first")
    replace(target, runs=scratch_dir(spark, "elsewhere")).append(batch, SECOND_RUN, "second")
    return target.load(spark)


def target_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored columns in order, with their types and how many values each holds."""
    target = _target(spark, partition_by=("year", "month", "day"))
    target.append(_batch(spark, sf_dir), FIRST_RUN)
    stored = spark.read.parquet(target.path)
    filled = stored.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i).cast("long").alias("position"),
                    F.lit(f.name).alias("name"),
                    F.lit(f.dataType.simpleString()).alias("type"),
                    F.count(f"`{f.name}`").alias("n_values"),
                )
                for i, f in enumerate(stored.schema)
            ]
        ).alias("columns")
    )
    return filled.select(F.inline("columns"))


def _partitions(transform: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Three runs' rows, read back from a cut-off between them, and the partition each is stored in."""
        target = _target(spark, partition_by=transform)
        posts = views.posts(spark, sf_dir).select("post_key", "post_type")
        for third, now in enumerate((datetime(2023, 11, 30, 23, 30), FIRST_RUN, SECOND_RUN)):
            target.append(posts.filter(F.col("post_key") % 3 == third), now)
        stored = spark.read.parquet(target.path)
        numbers = stored.select("post_key", "written_at", F.col(f"written_at_{transform}").alias("partition_number"))
        return target.load(spark, CUTOFF).join(numbers, ["post_key", "written_at"])

    return query


# Jobs


def _sentiment_job(spark: SparkSession, sf_dir: str, **options) -> Job:
    return Job(
        sources=(
            _source(views.reactions(spark, sf_dir), "event_id"),
            _source(views.posts(spark, sf_dir)),
        ),
        target=_target(spark, partition_by="month"),
        model=SENTIMENT,
        include=("post_message",),
        hours=WHOLE_MONTH,
        workers=4,
        seed=SEED,
        **options,
    )


def _needs_job(spark: SparkSession, sf_dir: str) -> Job:
    return Job(
        sources=(_source(views.posts(spark, sf_dir)),),
        target=_target(spark, partition_by="month"),
        model=USER_NEEDS,
        include=("post_message",),
        hours=WHOLE_MONTH,
        seed=SEED,
    )


def _two_runs(spark: SparkSession, job: Job, scorer: Native, max_records: int | None = None) -> DataFrame:
    run_job(spark, job, scorer, max_records, now=FIRST_RUN)
    run_job(spark, job, scorer, max_records, now=SECOND_RUN)
    return job.target.load(spark)


def sentiment_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs over all reactions and posts; the target afterwards."""
    return _two_runs(spark, _sentiment_job(spark, sf_dir), Native(SENTIMENT_WORDS))


def sentiment_job_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`sentiment_job` with every join done as for tables too large to broadcast."""
    job = _sentiment_job(spark, sf_dir, large=True, hot_rows=TEST_HOT_ROWS)
    return _two_runs(spark, job, Native(SENTIMENT_WORDS))


def sentiment_job_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with at most 2,000 rows per run."""
    return _two_runs(spark, _sentiment_job(spark, sf_dir), Native(SENTIMENT_WORDS), 2_000)


def sentiment_job_sampled_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for large tables: ids are joined and sampled first, texts fetched afterwards."""
    job = _sentiment_job(spark, sf_dir, large=True, hot_rows=TEST_HOT_ROWS)
    return _two_runs(spark, job, Native(SENTIMENT_WORDS), 2_000)


def _as_table(df: DataFrame, name: str) -> dict[str, str]:
    """A catalog entry for a job definition."""
    df.createOrReplaceGlobalTempView(name)
    return {"database": "global_temp", "table": name, "index_field": "post_key", "datetime_field": "last_update_time"}


def _configured(spark: SparkSession, sources: list[dict], response_format: str, partition_by: str) -> Job:
    """A job from a definition as a user writes it."""
    name = f"freshet_{uuid.uuid4().hex}"
    target = {"database": "default", "table": name, "index_field": "post_key", "datetime_field": "written_at"}
    config = {
        "connector": {
            "source": {"tables": sources, "time_filter_hours": WHOLE_MONTH},
            "target": {**target, "location": scratch_dir(spark, name), "partition_by": partition_by},
        },
        "inference": {
            "workers": 20,
            "response_format": response_format,
            "include_fields": ["post_type", "post_message", "n_chars"],
        },
    }
    return Job.from_config(config, seed=SEED)


def sentiment_job_completer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job as it is scheduled: two tables, at most 2,000 rows per run, a model that fails on some,
    whose rows come again in the second run."""
    tables = [
        _as_table(views.reactions(spark, sf_dir), "freshet_reactions"),
        _as_table(views.posts(spark, sf_dir), "freshet_posts"),
    ]
    job = _configured(spark, tables, "sentiment", "month")
    job = replace(job, sources=(replace(job.sources[0], row_id=("event_id",)), job.sources[1]))
    return _two_runs(spark, job, Completer(rule_completer), 2_000)


def needs_completer(prompt: str, payload: str) -> str:
    """Nested answers by the post's length; refused, or of an unknown type, for some."""
    length = json.loads(payload)["n_chars"]
    if length % 11 == 0:
        raise RuntimeError("refused")
    groups = {}
    for i, group in enumerate(f for f in USER_NEEDS.fields if f.fields):
        kinds = group.fields[0].allowed
        kind = "something else" if length % 13 == 0 else kinds[(length + i) % 2]
        groups[group.name] = {"type": kind, "score": length % 101 / 100, "confidence": 0.5}
    return json.dumps({**groups, "summary": f"{length} characters"})


def user_needs_job_completer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table, every new row, nested answers."""
    job = _configured(spark, [_as_table(views.posts(spark, sf_dir), "freshet_posts")], "user_needs", "day")
    return _two_runs(spark, job, Completer(needs_completer))


def empty_completer(prompt: str, payload: str) -> str:
    return ""


def run_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that end early: nothing in the window, and no valid answer. Neither makes a target."""
    rows = []
    for case, hours, now in (("no_rows", 1, datetime(2030, 1, 1)), ("no_valid", WHOLE_MONTH, FIRST_RUN)):
        job = replace(_needs_job(spark, sf_dir), hours=hours)
        summary = run_job(spark, job, Completer(empty_completer), None, now=now)
        rows.append((case, summary.scored, summary.written, job.target.load(spark) is not None))
    return spark.createDataFrame(rows, "run string, scored long, written long, target_made boolean")


def user_needs_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_runs(spark, _needs_job(spark, sf_dir), Native(NEEDS_WORDS))


def reprocess_after_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _needs_job(spark, sf_dir)
    run_job(spark, job, Native(NEEDS_WORDS), None, now=FIRST_RUN)
    run_job(spark, job, Native(NEEDS_WORDS), None, now=SECOND_RUN, drop=True)
    return job.target.load(spark).select("written_at", "post_key")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a run with a fallible model, and of a second one that finds nothing new but
    the rejected and the later rows."""
    job = Job(
        sources=(_source(views.posts(spark, sf_dir)),),
        target=_target(spark),
        model=SENTIMENT,
        include=("post_type", "post_message", "n_chars"),
        hours=WHOLE_MONTH,
        workers=4,
        seed=SEED,
    )
    rows = []
    for run, now in enumerate((FIRST_RUN, SECOND_RUN), start=1):
        summary = run_job(spark, job, Completer(rule_completer), None, now=now, count_available=True)
        counts = {"available": summary.available, "scored": summary.scored, "written": summary.written}
        rows += [(run, name, n) for name, n in {**counts, **summary.rejected}.items()]
    return spark.createDataFrame(rows, "run int, count_of string, n long")


def result_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adhoc_inner_window(spark, sf_dir).drop("value")
    return result_profile(rows, ["post_key", "event_id"])


def _stream_documents(spark: SparkSession, sf_dir: str, job: Job, **options) -> None:
    """All documents as a stream from its beginning, of a single file or a folder of them: a pattern
    matches either, a plain path only a folder."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stream = spark.readStream.schema(documents.schema).parquet(f"{sf_dir}/document[s].parquet")
    query = start_stream(
        views.as_posts(stream), job, Native(NEEDS_WORDS), scratch_dir(spark, "stream"), lambda: SECOND_RUN, **options
    )
    query.awaitTermination()


def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch run, then a stream of all documents through the same job."""
    job = _needs_job(spark, sf_dir)
    run_job(spark, job, Native(NEEDS_WORDS), None, now=FIRST_RUN)
    _stream_documents(spark, sf_dir, job)
    return job.target.load(spark)


def stream_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in one batch of a stream, scored in four triggers of a quarter each."""
    job = replace(_needs_job(spark, sf_dir), target=_target(spark, runs=scratch_dir(spark, "runs")))
    backlog = Backlog(scratch_dir(spark, "backlog"))
    quarter = -(-views.posts(spark, sf_dir).count() // 4)
    _stream_documents(spark, sf_dir, job, max_records=quarter, backlog=backlog)
    for hour in (1, 2, 3):
        work_off(spark, job, Native(NEEDS_WORDS), backlog, quarter, SECOND_RUN + timedelta(hours=hour))
    return job.target.load(spark)


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, and the stream once more with its state lost: the target stays as it is."""
    job = _needs_job(spark, sf_dir)
    run_job(spark, job, Native(NEEDS_WORDS), None, now=FIRST_RUN)
    for _ in range(2):
        _stream_documents(spark, sf_dir, job)
    return job.target.load(spark)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_window": scan_window_query,
    "scan_relative_window": scan_relative_window,
    "multi_source_empty_cold": multi_source_empty_cold,
    "multi_source_empty_warm": multi_source_empty_warm,
    "state_scan": state_scan,
    "adhoc_inner_window": adhoc_inner_window,
    "adhoc_sql": adhoc_sql,
    "write_append_roundtrip": write_append_roundtrip,
    "write_once": write_once,
    "target_layout": target_layout,
    "partition_year": _partitions("year"),
    "partition_month": _partitions("month"),
    "partition_day": _partitions("day"),
    "reprocess_after_drop": reprocess_after_drop,
    "project_include": project_include_query,
    "project_exclude": project_exclude_query,
    "state_latest": state_latest,
    "state_oldest": state_oldest,
    "state_kept": state_kept,
    "incremental_latest": incremental_latest,
    "incremental_oldest": incremental_oldest,
    "incremental_null_key": incremental_null_key,
    "incremental_pending": _large_state(),
    "incremental_filtered": _large_state(max_pending=1),
    "incremental_shuffled": _large_state(max_pending=0),
    "incremental_salted": _large_state(max_pending=0, hot_rows=TEST_HOT_ROWS),
    "join_left_two": join_left_two,
    "join_left_three": join_left_three,
    "join_left_salted": join_left_salted,
    "join_salted_both_sides": join_salted_both_sides,
    "join_last_wins": join_last_wins,
    "recent_first": recent_first_query,
    "sample_seeded": sample_seeded,
    "sample_large": sample_large,
    "sample_overask": sample_overask,
    "sample_random": sample_random,
    "fmt_iso_timestamp": fmt_iso_timestamp,
    "fmt_bytes": fmt_bytes,
    "payload_json": payload_json_query,
    "payload_text": payload_text,
    "prompt_messages": prompt_messages_query,
    "response_parse": response_parse,
    "response_valid": response_valid,
    "response_rejects": response_rejects,
    "response_domain": response_domain,
    "flatten_user_needs": flatten_user_needs,
    "enrich_sentiment": enrich_sentiment,
    "enrich_user_needs": enrich_user_needs,
    "enrich_distilled": enrich_distilled,
    "score_batch": score_batch,
    "score_retry": score_retry,
    "score_resumed": score_resumed,
    "score_keeps_key": score_keeps_key,
    "result_profile": result_profile_query,
    "run_summary": run_summary,
    "sentiment_job": sentiment_job,
    "sentiment_job_salted": sentiment_job_salted,
    "sentiment_job_sampled": sentiment_job_sampled,
    "sentiment_job_sampled_salted": sentiment_job_sampled_salted,
    "sentiment_job_completer": sentiment_job_completer,
    "user_needs_job": user_needs_job,
    "user_needs_job_completer": user_needs_job_completer,
    "run_empty": run_empty,
    "stream_incremental": stream_incremental,
    "stream_replay": stream_replay,
    "stream_capped": stream_capped,
}
