"""DuckDB SQL with the result each catalogue query must have."""

from __future__ import annotations

from freshet.functions.models import SENTIMENT, USER_NEEDS
from freshet.plans.catalogue import NEEDS_WORDS, SEED, SENTIMENT_WORDS

_VIEWS = {
    "posts": """
        select doc_id as post_key, timestamp '2024-01-01' + to_hours(cast(doc_id % 720 as int)) as last_update_time,
               source as post_type, lang, text as post_message, n_chars
        from documents""",
    "reactions": """
        select case when event_id % 97 = 0 then null else user_id end as post_key, event_id,
               ts as last_update_time, event_type, value
        from events""",
    "quality": """
        select doc_id as post_key,
               timestamp '2024-01-01' + to_hours(cast((doc_id * 7) % 720 as int)) as last_update_time, quality, toxic
        from labels""",
    "processed": """
        select doc_id as post_key, timestamp '2024-01-01' + to_hours(cast((doc_id * 13) % 720 as int)) as written_at
        from labels
        union all
        select doc_id, timestamp '2024-01-01' + to_hours(cast((doc_id * 31) % 720 as int)) from labels""",
    "processed_nullkey": """
        select case when post_key % 50 = 0 then null else post_key end as post_key, written_at from processed""",
    "answers": """
        select event_id,
               case event_id % 16
                 when 0 then '{"score":' || v || ',"sentiment":"positive","confidence":0.9}'
                 when 1 then ''
                 when 2 then 'not json ' || event_type
                 when 3 then '[]'
                 when 4 then '{}'
                 when 5 then '{"":' || v || '}'
                 when 6 then '{"score":"' || v || '","sentiment":"positive","confidence":0.9}'
                 when 7 then '{"score":' || v || '}'
                 when 8 then null
                 when 9 then v
                 when 10 then '{"score":' || v
                 when 11 then '{"score":' || v || ',"sentiment":"' || event_type || '","confidence":0.9}'
                 when 12 then '{"score":' || v || ',"sentiment":"neutral","confidence":0.25,"extra":true}'
                 when 13 then '{"score":' || v || ',"sentiment":"neutral","confidence":0.25} as asked'
                 when 14 then '{"score":null,"sentiment":"neutral","confidence":' || v || '}'
                 when 15 then ' {"confidence":0.5,"sentiment":"negative","score":-' || v || '}' || chr(10)
               end as content,
               case when event_id % 17 = 0 then 'refused: ' || event_type end as error
        from (select *, cast(value as varchar) as v from events)""",
}


def _with(views: str, sql: str) -> str:
    ctes = ", ".join(f"{name} as ({_VIEWS[name]})" for name in views.split())
    return f"with {ctes} {sql}"


def _list(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{word}'" for word in words) + ")"


_TOKENS = "list_filter(string_split_regex(lower({text}), '[^a-z]+'), lambda t: t <> '')"


def _hits(words: tuple[str, ...]) -> str:
    return f"len(list_filter(tokens, lambda t: t in {_list(words)}))"


def _sentiment(source: str, text: str = "post_message", keep: str = "post_key") -> str:
    """Score, sentiment and confidence of `text` for each row of `source`."""
    return f"""
        select {keep}, score,
               case when score > 0.1 then 'positive' when score < -0.1 then 'negative' else 'neutral' end as sentiment,
               confidence
        from (select *, round((pos - neg) / greatest(pos + neg, 1), 6) as score,
                     round((pos + neg) / greatest(len(tokens), 1), 6) as confidence
              from (select *, {_hits(SENTIMENT_WORDS.positive)} as pos, {_hits(SENTIMENT_WORDS.negative)} as neg
                    from (select *, {_TOKENS.format(text=f"coalesce({text}, '')")} as tokens from {source})))"""


def _needs(source: str, keep: str = "post_key") -> str:
    counts, columns, kinds = [], [], []
    for field in USER_NEEDS.fields:
        if not field.fields:
            continue
        name, (first, second) = field.name, NEEDS_WORDS.words[field.name]
        allowed = field.fields[0].allowed
        counts += [f"{_hits(first)} as {name}_a", f"{_hits(second)} as {name}_b"]
        kind = f"case when {name}_a >= {name}_b then '{allowed[0]}' else '{allowed[1]}' end"
        kinds.append(kind)
        columns += [
            f'{kind} as "{name}.type"',
            f'round(greatest({name}_a, {name}_b) / greatest({name}_a + {name}_b, 1), 6) as "{name}.score"',
            f'round(({name}_a + {name}_b) / greatest(len(tokens), 1), 6) as "{name}.confidence"',
        ]
    return f"""
        select {keep}, {", ".join(columns)}, concat_ws('; ', {", ".join(kinds)}) as summary
        from (select *, {", ".join(counts)}
              from (select *, {_TOKENS.format(text="coalesce(post_message, '')")} as tokens from {source}))"""


_NULL_NEEDS = "cast(null as varchar) as reject_reason"


# Incremental filter


def _state(pick: str, view: str = "processed") -> str:
    return f"(select post_key as state_key, {pick}(written_at) as state_ts from {view} group by post_key)"


def _new(source: str, state: str, where: str = "true") -> str:
    return f"""
        select s.* from {source} s where {where} and not exists (
          select 1 from {state} d
          where s.post_key is not distinct from d.state_key and s.last_update_time <= d.state_ts)"""


# Python's JSON text: printable ASCII as it is, the rest as lower-case \uXXXX.

_CHARACTER = r"""case
    when c = '"' then '\"' when c = '\' then '\\' when c = chr(8) then '\b' when c = chr(12) then '\f'
    when c = chr(10) then '\n' when c = chr(13) then '\r' when c = chr(9) then '\t'
    when ord(c) between 32 and 126 then c
    when ord(c) < 65536 then '\u' || lpad(lower(to_hex(ord(c))), 4, '0')
    else '\u' || lower(to_hex(55296 + (ord(c) - 65536) // 1024)) || '\u' || lower(to_hex(56320 + (ord(c) - 65536) % 1024))
  end"""


def _json_text(column: str) -> str:
    """By code points, so that no accent sticks to its letter."""
    characters = f"regexp_extract_all({column}, '(?s).')"
    return f"""'"' || array_to_string(list_transform({characters}, lambda c: {_CHARACTER}), '') || '"'"""


def _iso(column: str) -> str:
    return (
        f"case when date_part('microsecond', {column}) % 1000000 = 0 then strftime({column}, '%Y-%m-%dT%H:%M:%S') "
        f"else strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') end"
    )


# Answers

_PARSED = """
    parsed as (
      select event_id, content, error, case
        when error is not null then 'call_error'
        when coalesce(content, '') = '' then 'empty_content'
        when not json_valid(content) then 'invalid_json'
        when json_type(content) <> 'OBJECT' then 'invalid_json'
        when len(json_keys(content)) = 0 then 'empty_object'
        when list_contains(json_keys(content), '') then 'empty_key'
        when coalesce(json_type(content, '$.score'), 'NULL') not in ('DOUBLE', 'BIGINT', 'UBIGINT', 'NULL')
          or coalesce(json_type(content, '$.confidence'), 'NULL') not in ('DOUBLE', 'BIGINT', 'UBIGINT', 'NULL')
          or coalesce(json_type(content, '$.sentiment'), 'NULL') not in ('VARCHAR', 'NULL') then 'type_mismatch'
        when json_extract_string(content, '$.sentiment') not in ('positive', 'negative', 'neutral') then 'domain'
        when json_extract_string(content, '$.score') is null or json_extract_string(content, '$.sentiment') is null
          or json_extract_string(content, '$.confidence') is null then 'missing_field'
      end as reject_reason
      from answers),
    results as (
      select event_id,
             case when reject_reason is null then cast(json_extract_string(content, '$.score') as double) end as score,
             case when reject_reason is null then json_extract_string(content, '$.sentiment') end as sentiment,
             case when reject_reason is null then cast(json_extract_string(content, '$.confidence') as double) end as confidence,
             reject_reason
      from parsed)"""


def _answers(sql: str) -> str:
    return f"with answers as ({_VIEWS['answers']}), {_PARSED} {sql}"


# The rule completer on posts

_RULED = """
    ruled as (
      select post_key, n_chars, last_update_time, case
        when n_chars % 11 = 0 then 'call_error'
        when n_chars % 13 = 0 then 'invalid_json'
        when n_chars % 7 = 0 then 'empty_content' end as reject_reason,
        (n_chars % 201 - 100) / 100 as s
      from posts)"""


# Jobs: run 1 stamps everything with the first time, run 2 takes what was updated after it.


def _sentiment_runs(limit: int | None) -> str:
    cut = ""
    if limit is not None:
        ids = "coalesce(cast(post_key as varchar), ''), cast(event_id as varchar), coalesce(cast(posted_at as varchar), '')"
        cut = f"order by md5(concat_ws(':', '{SEED}', {ids})), event_id limit {limit}"
    joined = "select r.post_key, r.event_id, p.post_message, p.last_update_time as posted_at from {r} r left join {p} p on r.post_key = p.post_key"
    return _with(
        "posts reactions",
        f"""
        , run1 as (select * from ({joined.format(r="reactions", p="posts")}) {cut}),
        done as (select distinct post_key, timestamp '2024-01-16' as written_at from run1),
        new_reactions as ({_new("reactions", _state("max", "done"), "s.last_update_time >= timestamp '2024-01-01'")}),
        new_posts as ({_new("posts", _state("max", "done"), "s.last_update_time >= timestamp '2024-01-01'")}),
        run2 as (select * from ({joined.format(r="new_reactions", p="new_posts")}) {cut}),
        runs as (select *, timestamp '2024-01-16' as written_at from run1
                 union all select *, timestamp '2024-01-31' from run2)
        {_sentiment("runs", keep="post_key, written_at")}""",
    )


def _partitions(number: str) -> str:
    """The second and third run's thirds of the posts."""
    return _with(
        "posts",
        f"""
        , runs as (select post_key, post_type, case post_key % 3 when 1 then timestamp '2024-01-16'
                          when 2 then timestamp '2024-01-31' end as written_at from posts where post_key % 3 > 0)
        select post_key, post_type, written_at, cast({number} as int) as partition_number from runs""",
    )


_ANSWERED = "n_chars % 11 <> 0 and n_chars % 13 <> 0 and n_chars % 7 <> 0"


def _completer_runs(limit: int) -> str:
    """Rows without a post have no length, which the completer fails on; failed rows leave no state."""
    ids = "coalesce(cast(post_key as varchar), ''), cast(event_id as varchar), coalesce(cast(posted_at as varchar), '')"
    cut = f"order by md5(concat_ws(':', '{SEED}', {ids})), event_id limit {limit}"
    joined = "select r.post_key, r.event_id, p.n_chars, p.last_update_time as posted_at from {r} r left join {p} p on r.post_key = p.post_key"
    return _with(
        "posts reactions",
        f"""
        , run1 as (select * from ({joined.format(r="reactions", p="posts")}) {cut}),
        done as (select distinct post_key, timestamp '2024-01-16' as written_at from run1 where {_ANSWERED}),
        new_reactions as ({_new("reactions", _state("max", "done"), "s.last_update_time >= timestamp '2024-01-01'")}),
        new_posts as ({_new("posts", _state("max", "done"), "s.last_update_time >= timestamp '2024-01-01'")}),
        run2 as (select * from ({joined.format(r="new_reactions", p="new_posts")}) {cut}),
        runs as (select *, timestamp '2024-01-16' as written_at from run1
                 union all select *, timestamp '2024-01-31' from run2)
        select post_key, written_at, s as score, cast(0.5 as double) as confidence,
               case when s > 0 then 'positive' when s < 0 then 'negative' else 'neutral' end as sentiment
        from (select *, (n_chars % 201 - 100) / 100 as s from runs where {_ANSWERED})""",
    )


def _completer_needs() -> str:
    columns = []
    for i, group in enumerate(f for f in USER_NEEDS.fields if f.fields):
        first, second = group.fields[0].allowed
        columns += [
            f"case (n_chars + {i}) % 2 when 0 then '{first}' else '{second}' end as \"{group.name}.type\"",
            f'(n_chars % 101) / 100 as "{group.name}.score"',
            f'cast(0.5 as double) as "{group.name}.confidence"',
        ]
    return _with(
        "posts",
        f"""
        , answered as (select *, n_chars % 11 <> 0 and n_chars % 13 <> 0 as good from posts),
        runs as (select *, timestamp '2024-01-16' as written_at from answered where good
                 union all
                 select *, timestamp '2024-01-31' from answered where good and last_update_time > timestamp '2024-01-16')
        select post_key, written_at, {", ".join(columns)}, n_chars || ' characters' as summary from runs""",
    )


_NEEDS_RUNS = _with(
    "posts",
    f"""
    , runs as (
      select *, timestamp '2024-01-16' as written_at from posts
      union all
      select *, timestamp '2024-01-31' from posts where last_update_time > timestamp '2024-01-16')
    {_needs("runs", keep="post_key, written_at")}""",
)

_CAPPED = _with(
    "posts",
    f"""
    , ranked as (
      select *, row_number() over (order by md5(concat_ws(':', '{SEED}', cast(post_key as varchar),
                                                          cast(last_update_time as varchar))), post_key) - 1 as place
      from posts),
    runs as (
      select *, timestamp '2024-01-31' + place // ((select count(*) + 3 from posts) // 4) * interval 1 hour as written_at
      from ranked)
    {_needs("runs", keep="post_key, written_at")}""",
)

_JOIN_LEFT_TWO = """
    select p.post_key, p.last_update_time, p.post_type, p.lang, p.n_chars,
           r.event_id, r.last_update_time as last_update_time_2, r.event_type, r.value
    from posts p left join reactions r on p.post_key = r.post_key"""

_SAMPLED = f"""
    select p.post_key, r.event_id, p.post_type, r.event_type
    from posts p left join reactions r on p.post_key = r.post_key
    order by md5(concat_ws(':', '{SEED}', cast(p.post_key as varchar), coalesce(cast(r.event_id as varchar), ''))),
             p.post_key, r.event_id
    limit """

_PROMPT = SENTIMENT.prompt.replace("'", "''")

ORACLES: dict[str, str] = {
    "scan_window": _with("reactions", "select * from reactions where last_update_time >= timestamp '2024-01-03'"),
    "scan_relative_window": _with(
        "reactions",
        """select * from reactions
           where last_update_time >= (select max(last_update_time) - to_hours(48) from reactions)""",
    ),
    "multi_source_empty_cold": _with(
        "posts reactions",
        """select p.post_key, p.n_chars, r.event_id, r.last_update_time as reacted_at
           from (select * from posts where last_update_time >= timestamp '2024-01-05') p
           left join (select * from reactions where last_update_time >= timestamp '2024-01-05') r
             on p.post_key = r.post_key""",
    ),
    "multi_source_empty_warm": _with(
        "posts reactions processed quality",
        f"""
        , done as (select post_key, timestamp '2024-01-05' as written_at from processed group by post_key),
        recent as (select * from reactions where last_update_time >= timestamp '2024-01-05'),
        stale as (select * replace (last_update_time - to_hours(720) as last_update_time) from quality),
        new_posts as ({_new("posts", _state("max", "done"), "s.last_update_time >= timestamp '2024-01-05'")}),
        new_reactions as ({_new("recent", _state("max", "done"))}),
        joined as (select 1 from new_posts p left join new_reactions r on p.post_key = r.post_key)
        select 'all' as sources, count(*) as n from joined
        where exists (select 1 from stale where last_update_time >= timestamp '2024-01-05')
        union all
        select 'without the empty one', count(*) from joined""",
    ),
    "state_scan": _with(
        "processed",
        """select post_key, cast(max(hour(written_at)) as int) as hour, timestamp '2024-01-16' as written_at
           from processed group by post_key""",
    ),
    "adhoc_inner_window": _with(
        "posts reactions",
        """select p.post_key, p.last_update_time, p.post_type, p.lang, p.n_chars,
                  r.event_id, r.last_update_time as last_update_time_2, r.event_type, r.value
           from posts p join reactions r on p.post_key = r.post_key
           where p.last_update_time >= timestamp '2024-01-03' and r.last_update_time >= timestamp '2024-01-03'""",
    ),
    "adhoc_sql": _with(
        "posts reactions",
        """select p.post_key, p.last_update_time as posted_at, p.post_type, p.lang, p.n_chars,
                  r.event_id, r.last_update_time as reacted_at, r.event_type, r.value
           from reactions r join posts p on r.post_key = p.post_key
           where r.last_update_time >= timestamp '2024-01-03' and p.last_update_time >= timestamp '2024-01-03'""",
    ),
    "write_append_roundtrip": _with(
        "posts",
        f"""
        , scored as ({_sentiment("posts")})
        select *, timestamp '2024-01-16' as written_at from scored
        union all select *, timestamp '2024-01-31' from scored""",
    ),
    "write_once": _with(
        "posts",
        f"""
        , scored as ({_sentiment("posts")})
        select *, timestamp '2024-01-16' as written_at from scored""",
    ),
    "target_layout": """
        select position, name, type, (select count(*) from documents) as n_values
        from (values (0, 'written_at', 'timestamp_ntz'), (1, 'score', 'double'), (2, 'sentiment', 'string'),
                     (3, 'confidence', 'double'), (4, 'post_key', 'bigint'), (5, 'written_at_year', 'int'),
                     (6, 'written_at_month', 'int'), (7, 'written_at_day', 'int')) as t(position, name, type)""",
    "partition_year": _partitions("year(written_at) - 1970"),
    "partition_month": _partitions("(year(written_at) - 1970) * 12 + month(written_at) - 1"),
    "partition_day": _partitions("date_diff('day', date '1970-01-01', cast(written_at as date))"),
    "reprocess_after_drop": _with("posts", "select timestamp '2024-01-31' as written_at, post_key from posts"),
    "project_include": _with("posts", "select post_key, post_message from posts"),
    "project_exclude": _with("posts", "select post_key, last_update_time, post_type, lang from posts"),
    "state_latest": _with("processed", f"select * from {_state('max')}"),
    "state_oldest": _with("processed", f"select * from {_state('min')}"),
    "state_kept": _with(
        "posts",
        """select post_key as state_key,
                  case when post_key % 3 = 0 then timestamp '2024-01-31' else timestamp '2024-01-16' end as state_ts
           from posts""",
    ),
    "enrich_distilled": _with(
        "posts",
        r"""select post_key, cast(len(regexp_extract_all(coalesce(post_message, ''), '[\p{L}\p{N}]+')) as bigint) as n_words,
                  true as answered
           from posts""",
    ),
    "incremental_latest": _with("reactions processed", _new("reactions", _state("max"))),
    "incremental_oldest": _with("reactions processed", _new("reactions", _state("min"))),
    **{
        f"incremental_{name}": _with(
            "reactions processed processed_nullkey", _new("reactions", _state("max", "processed_nullkey"))
        )
        for name in ("null_key", "pending", "filtered", "shuffled", "salted")
    },
    "join_left_two": _with("posts reactions", _JOIN_LEFT_TWO),
    "join_left_three": _with(
        "posts reactions quality",
        """select p.post_key, p.last_update_time, p.post_type, p.lang, p.n_chars,
                  r.event_id, r.last_update_time as last_update_time_2, r.event_type, r.value,
                  q.last_update_time as last_update_time_3, q.quality, q.toxic
           from posts p left join reactions r on p.post_key = r.post_key
           left join quality q on p.post_key = q.post_key""",
    ),
    "join_left_salted": _with(
        "posts reactions quality",
        """select r.post_key, r.event_id, r.last_update_time, r.event_type, r.value,
                  p.last_update_time as last_update_time_2, p.post_type, p.lang, p.n_chars,
                  q.last_update_time as last_update_time_3, q.quality, q.toxic
           from reactions r left join posts p on r.post_key = p.post_key
           left join quality q on r.post_key = q.post_key""",
    ),
    "join_salted_both_sides": _with(
        "reactions",
        """select e.post_key, e.event_id, o.event_type, o.n
           from (select * from reactions where event_id % 2 = 0) e
           left join (select post_key, event_type, count(*) as n from reactions where event_id % 2 = 1
                      group by post_key, event_type) o on e.post_key = o.post_key""",
    ),
    "join_last_wins": _with(
        "posts reactions",
        """select r.post_key, r.event_id, p.last_update_time, r.event_type, r.value, p.post_type, p.lang, p.n_chars
           from reactions r left join posts p on r.post_key = p.post_key""",
    ),
    "recent_first": _with(
        "reactions", "select * from reactions order by last_update_time desc nulls last, event_id limit 100"
    ),
    "sample_seeded": _with("posts reactions", _SAMPLED + "500"),
    "sample_large": _with("posts reactions", _SAMPLED + "10400"),
    "sample_overask": _with("posts reactions", _SAMPLED + "100000000"),
    "sample_random": "select least(count(*), 500) as n, least(count(distinct event_id), 500) as n_distinct from events",
    "fmt_iso_timestamp": _with(
        "posts",
        f"""select event_id as id, {_iso("ts")} as iso from events
            union all select post_key, {_iso("last_update_time")} from posts""",
    ),
    "fmt_bytes": _with(
        "posts",
        r"""select post_key, case when regexp_full_match(post_message, '[\x00-\x7F]*') then post_message
                   else lower(hex(encode(post_message))) end as message
            from posts""",
    ),
    "payload_json": _with(
        "reactions",
        f"""select event_id,
                   '{{"post_key": ' || coalesce(cast(post_key as varchar), 'null') || ', "event_id": ' || event_id
                   || ', "last_update_time": "' || {_iso("last_update_time")} || '", "event_type": "' || event_type
                   || '", "value": ' || cast(value as varchar) || '}}' as payload
            from reactions""",
    ),
    "payload_text": _with(
        "posts",
        f"""select post_key, '{{"lang": "' || lang || '", "post_message": ' || {_json_text("post_message")} || '}}' as payload
            from posts""",
    ),
    "prompt_messages": _with(
        "posts",
        f"""select post_key, 'system' as role, '{_PROMPT}' as content from posts
            union all
            select post_key, 'user', '{{"post_key": ' || post_key || ', "post_type": "' || post_type || '"}}' from posts""",
    ),
    "response_parse": _answers("select * from results"),
    "response_valid": _answers("select * exclude (reject_reason) from results where reject_reason is null"),
    "response_rejects": _answers(
        "select reject_reason, count(*) as n from results where reject_reason is not null group by reject_reason"
    ),
    "response_domain": _answers("select event_id, reject_reason from results where reject_reason = 'domain'"),
    "flatten_user_needs": _with("posts", f"select *, {_NULL_NEEDS} from ({_needs('posts')})"),
    "enrich_sentiment": _with("posts", _sentiment("posts")),
    "enrich_user_needs": _with("posts", _needs("posts")),
    **dict.fromkeys(("score_batch", "score_resumed"), _with(
        "posts",
        f"""
        , {_RULED}
        select post_key, case when reject_reason is null then s end as score,
               case when reject_reason is null then
                 case when s > 0 then 'positive' when s < 0 then 'negative' else 'neutral' end end as sentiment,
               case when reject_reason is null then cast(0.5 as double) end as confidence, reject_reason
        from ruled""",
    )),
    "score_retry": _with(
        "posts",
        """select post_key, case when n_chars % 7 < 5 then 'after ' || (n_chars % 7 + 1) end as content,
                  case when n_chars % 7 >= 5 then 'RateLimited: busy' end as error
           from posts""",
    ),
    "score_keeps_key": _with(
        "reactions",
        """select post_key, event_id,
                  '{"event_id": ' || event_id || ', "event_type": "' || event_type || '"}' as content
           from reactions""",
    ),
    "result_profile": _with(
        "posts reactions",
        f"""
        , joined as (
          select p.post_key, p.last_update_time, p.post_type, p.lang, p.n_chars,
                 r.event_id, r.last_update_time as last_update_time_2, r.event_type
          from posts p join reactions r on p.post_key = r.post_key
          where p.last_update_time >= timestamp '2024-01-03' and r.last_update_time >= timestamp '2024-01-03')
        select count(*) as row_count, cast(8 as bigint) as column_count,
               (select concat_ws(',', post_key, {_iso("last_update_time")}, post_type, lang, n_chars,
                                 event_id, {_iso("last_update_time_2")}, event_type)
                from joined order by post_key, event_id limit 1) as first_record
        from joined""",
    ),
    "run_summary": _with(
        "posts",
        f"""
        , {_RULED},
        runs as (
          select 1 as run, reject_reason from ruled
          union all
          select 2, reject_reason from ruled
          where reject_reason is not null or last_update_time > timestamp '2024-01-16')
        select run, unnest(['available', 'scored']) as count_of, count(*) as n from runs group by run
        union all
        select run, 'written', count(*) filter (reject_reason is null) from runs group by run
        union all
        select run, reject_reason, count(*) from runs where reject_reason is not null group by run, reject_reason""",
    ),
    "sentiment_job": _sentiment_runs(None),
    "sentiment_job_salted": _sentiment_runs(None),
    "sentiment_job_sampled": _sentiment_runs(2_000),
    "sentiment_job_sampled_salted": _sentiment_runs(2_000),
    "sentiment_job_completer": _completer_runs(2_000),
    "user_needs_job": _NEEDS_RUNS,
    "user_needs_job_completer": _completer_needs(),
    "run_empty": """
        select 'no_rows' as run, cast(0 as bigint) as scored, cast(0 as bigint) as written, false as target_made
        union all select 'no_valid', count(*), 0, false from documents""",
    "stream_incremental": _NEEDS_RUNS,
    "stream_replay": _NEEDS_RUNS,
    "stream_capped": _CAPPED,
}
