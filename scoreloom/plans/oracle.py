"""The results of the named queries in plain SQL, written from the definitions and not from the Spark plans.

Sequences are small in the checked data, so plain windows, correlated subqueries and step-by-step grids are
used freely here.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Common table expressions


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def notes(pitch: str = "21 + k % 88", name: str = "n") -> str:
    return f"""raw_{name} as (
  select event_id, cast(user_id as varchar) as seq_id, event_type, value,
    cast(regexp_extract(props, '[0-9]+') as int) as k,
    cast(date_diff('microsecond', timestamp '2024-01-01', ts) as double) / 14400000000e0 as st
  from events),
{name} as (
  select seq_id, event_id as note_idx, cast({pitch} as int) as pitch,
    1 + cast(floor(value) as int) % 127 as velocity, st as start_time, st + 0.25e0 * (1 + k % 4) as end_time,
    case event_type when 'click' then 0 when 'view' then 1 when 'purchase' then 2 when 'signup' then 3 else 9 end
      as instrument, event_type = 'error' as is_drum
  from raw_{name})"""


FEW = "60 + k % 5"

VARIED = (
    notes(name="m")
    + """,
early as (select seq_id, min(note_idx) as note_idx from m where cast(seq_id as bigint) % 17 = 0 group by 1),
n as (
  select m.seq_id, m.note_idx, pitch, velocity, instrument, is_drum,
    start_time - case when early.seq_id is null then 0e0 else 10e0 end as start_time,
    end_time - case when early.seq_id is null then 0e0 else 10e0 end as end_time
  from m left join early on m.seq_id = early.seq_id and m.note_idx = early.note_idx),
users as (select distinct seq_id, cast(seq_id as bigint) as u from m),
ev as (
  select seq_id, 'tempo' as kind, 0e0 as time, 60e0 as qpm, null::int as num, null::int as den from users
  union all select seq_id, 'tempo', 120e0, 90e0, null, null from users where u % 11 = 0
  union all select seq_id, 'time_signature', 0e0, null, case when u % 5 = 0 then 3 else 4 end,
    case when u % 13 = 0 then 3 else 4 end from users
  union all select seq_id, 'time_signature', 96e0, null, 3, 4 from users where u % 7 = 0),
pedal as (
  select seq_id, st as time, cast(floor(value) as int) % 128 as value, i.instrument
  from raw_m, (values (0), (1), (2), (3), (9)) i(instrument) where event_type = 'signup')"""
)


def quantized(source: str = "n", name: str = "q", rate: str = "4e0", bar: str = "16e0") -> str:
    return f"""{name}_ as (
  select *, cast(floor(start_time * {rate} + 0.5e0) as bigint) as q_start,
    greatest(cast(floor(end_time * {rate} + 0.5e0) as bigint), cast(floor(start_time * {rate} + 0.5e0) as bigint) + 1)
      as q_end
  from {source}),
{name} as (select *, {bar} as bar, max(q_end) over (partition by seq_id) as total_steps from {name}_)"""


def slices(source: str, name: str = "s", size: int = 4, hop: int = 1, where: str = "not short", extra: str = "") -> str:
    """Notes in their slices by trying every slice number, with the flags that the options look at."""
    return f"""{name}_k as (
  select seq_id, max(bar) as bar, max(total_steps) as total, unnest(range(0, cast(ceil(max(total_steps) / max(bar)) as bigint) + 1)) as k
  from {source} group by seq_id),
{name}_all as (
  select x.*, k.k, k.k * {hop} * x.bar as s0, k.k * {hop} * x.bar + {size} * x.bar as s1,
    k.k * {hop} * x.bar + {size} * x.bar > ceil(k.total / x.bar) * x.bar as short
  from {source} x join {name}_k k on x.seq_id = k.seq_id
    and x.q_start >= k.k * {hop} * x.bar and x.q_start < k.k * {hop} * x.bar + {size} * x.bar),
{name}_cut as (
  select *, max(q_end > s1) over (partition by seq_id, k) as cropped,
    exists (select 1 from {source} y where y.seq_id = {name}_all.seq_id and y.q_start < s0 and y.q_end > s0) as cut_start
  from {name}_all),
{name} as (
  select seq_id || '#slice' || k as seq_id, note_idx{extra}, pitch, velocity, bar, q_start - cast(s0 as bigint) as q_start,
    least(q_end, cast(s1 as bigint)) - cast(s0 as bigint) as q_end,
    cast(least(s1, ceil(total_steps / bar) * bar) as bigint) - cast(s0 as bigint) as total_steps
  from {name}_cut where {where})"""


PER_SLICE = """select seq_id, count(*) as notes, sum(q_start)::bigint as starts, sum(q_end)::bigint as ends, sum(pitch)::bigint as pitches,
  max(total_steps) as total_steps from s group by seq_id"""


def line(source: str, name: str = "l", keys: str = "seq_id") -> str:
    """One note per step, the top one, cut at the next onset."""
    return f"""{name}_top as (
  select {keys}, q_start, max(row(pitch, q_end, velocity)) as t, max(bar) as bar, max(total_steps) as total_steps,
    count(*) as voices, arg_max(note_idx, row(pitch, q_end, velocity, -note_idx)) as note_idx
  from {source} group by {keys}, q_start),
{name} as (
  select {keys}, q_start, t[1] as pitch, t[2] as full_end, t[3] as velocity, bar, total_steps, voices, note_idx,
    least(t[2], coalesce(lead(q_start) over (partition by {keys} order by q_start), t[2])) as q_end
  from {name}_top)"""


def melodies(source: str, name: str = "mel", gap: int = 4, min_bars: int = 2, truncate=None, discard=None) -> str:
    limit = "true" if truncate is None else f"q_start - m0 < {truncate} * bar"
    kept = "bars" if truncate is None else f"least(bars, {truncate})"
    too_long = "false" if discard is None else f"bars > {discard}"
    truncated = "false" if truncate is None else f"bars >= {min_bars} and not ({too_long}) and bars > {truncate}"
    return f"""{name}_in as (select * from {source} where not is_drum and pitch between 21 and 108),
{line(name + "_in", name + "_line", "seq_id, instrument")},
{name}_gap as (
  select *, coalesce(q_start - lag(full_end) over (partition by seq_id, instrument order by q_start) >= {gap} * bar, true)
    as opens from {name}_line),
{name}_run as (
  select *, sum(opens::int) over (partition by seq_id, instrument order by q_start) as run from {name}_gap),
{name}_start as (
  select *, min(q_start) over (partition by seq_id, instrument, run) as first_q from {name}_run),
{name}_bar as (select *, first_q - first_q % cast(bar as bigint) as m0 from {name}_start),
{name}_stat as (
  select seq_id, instrument, m0, max(bar) as bar, cast(ceil((max(q_end) - m0) / max(bar)) as bigint) as bars,
    max(q_end) - m0 as len, count(distinct case when {limit} then pitch end) as pitches
  from {name}_bar group by seq_id, instrument, m0),
{name}_check as (
  select *, {kept} as kept_bars, least(len, {kept} * cast(bar as bigint)) as steps, {truncated} as truncated,
    case when bars < {min_bars} then 'melodies_discarded_too_short'
      when {too_long} then 'melodies_discarded_too_long'
      when pitches < 3 then 'melodies_discarded_too_few_pitches' end as reason
  from {name}_stat),
{name} as (
  select b.seq_id || '#melody' || b.instrument || '@' || b.m0 as seq_id, note_idx, b.q_start - b.m0 as q_start,
    least(b.q_end - b.m0, c.steps) as q_end, pitch, velocity, b.bar, c.steps as total_steps
  from {name}_bar b join {name}_check c on b.seq_id = c.seq_id and b.instrument = c.instrument and b.m0 = c.m0
  where c.reason is null and b.q_start - b.m0 < c.steps)"""


CUTS = """stated as (
  select seq_id, greatest(time, 0e0) as time, max(qpm) as qpm, max(num * 1000 + den) as sig from ev group by 1, 2),
filled as (
  select *, last_value(qpm ignore nulls) over (partition by seq_id order by time) as q1,
    last_value(sig ignore nulls) over (partition by seq_id order by time) as s1,
    last_value(qpm ignore nulls) over (partition by seq_id order by time rows between unbounded preceding and 1 preceding) as q0,
    last_value(sig ignore nulls) over (partition by seq_id order by time rows between unbounded preceding and 1 preceding) as s0
  from stated),
changes as (
  select seq_id, time, q1 as qpm, s1 as sig from filled
  where time = 0 or coalesce(q1, 120) <> coalesce(q0, 120) or coalesce(s1, 4004) <> coalesce(s0, 4004)),
cuts as (
  select *, lead(time) over (partition by seq_id order by time) as cut_end from changes where {kept})"""
ALL_CUTS = CUTS.format(kept="true")
FREE_CUTS = CUTS.format(
    kept="time = 0 or not exists (select 1 from n where n.seq_id = changes.seq_id "
    "and n.start_time < changes.time and n.end_time > changes.time)"
)
SEGMENTS = """seg as (
  select n.*, coalesce(c.time, 0e0) as seg_start, c.cut_end as seg_end, coalesce(c.qpm, 120e0) as qpm,
    coalesce(c.sig, 4004) as sig
  from (select *, greatest(start_time, 0e0) as at from n) n
    asof left join cuts c on n.seq_id = c.seq_id and n.at >= c.time)"""


def timed(op: str, source: str = "seg") -> str:
    return f"""select seq_id || '#{op}@' || cast(floor(seg_start * 1e6 + 0.5e0) as bigint) as seq_id, note_idx, pitch,
  round(start_time - seg_start, 6) as start_time,
  round(case when seg_end < end_time then seg_end else end_time end - seg_start, 6) as end_time from {source}"""


SILENCE = """gaps as (
  select *, coalesce(start_time - max(end_time) over (partition by seq_id order by start_time, note_idx
    rows between unbounded preceding and 1 preceding) > {gap}, true) as opens from n),
seg as (
  select *, max(case when opens then start_time end) over (partition by seq_id order by start_time, note_idx) as seg_start,
    null::double as seg_end from gaps)"""

U = "cast('0x' || substr(md5({key}), 1, 8) as bigint) / 4294967296e0"


def uniform(purpose: str, seed: int = 42, key: str = "seq_id") -> str:
    return U.format(key=f"'{seed}:' || {key} || ':{purpose}'")


SPLIT = f"""case when {uniform("split")} < 0.7e0 then 'train' when {uniform("split")} < 0.7e0 + 0.2e0 then 'validation' else 'test' end"""

# Sources and sinks

ORACLE["scan_sequences"] = (
    with_(notes())
    + "select seq_id, 'events/' || seq_id || '.mid' as filepath, round(max(end_time), 6) as total_time from n group by seq_id"
)
ORACLE["loader_scan"] = """select o_orderkey, o_totalprice, 0 as epoch,
  row_number() over (order by md5('stable:' || o_orderkey), o_orderkey) - 1 as position from orders"""
ORACLE["import_tree"] = (
    "select 'lang=' || lang as folder, sum(octet_length(encode(text)) + 1)::bigint as bytes from documents group by 1"
)
ORACLE["debug_tap"] = (
    with_(notes())
    + "select distinct seq_id, 'events/' || seq_id || '.mid' as filepath from n where regexp_matches(seq_id, '^1[0-9]')"
)
ORACLE["canonicalize_json"] = """select cast(event_id as varchar) as seq_id,
  cast(case when event_type = 'click' then 2 else 0 end as bigint) as notes,
  case when event_type = 'click' then 2 * cast(regexp_extract(props, '[0-9]+') as bigint) + 4 else 0 end as pitches,
  case event_type when 'click' then 'none' when 'signup' then 'malformed document' when 'view' then 'no decoder for midi'
    when 'purchase' then 'no decoder for musicxml' else 'Unsupported file type: .xyz' end as error
from events"""
ORACLE["format_dispatch"] = """select source_type, format, count(*) as files from (
  select case event_type when 'view' then '.mid' when 'purchase' then '.mxl' when 'error' then '.xyz' else '.json' end as source_type,
    case event_type when 'view' then 'midi' when 'purchase' then 'musicxml' when 'error' then 'unsupported' else 'json' end as format
  from events) group by all"""
ORACLE["overwrite_policy"] = (
    with_(notes()) + 'select distinct seq_id, true as "first", false as "second", true as "third" from n'
)
ORACLE["scan_index"] = """select doc_id::varchar as seq_id, 'raw/' || doc_id || '.txt' as filepath, sha256(text) as checksum,
  'documents' as collection_name, '{"lang":"' || lang || '"}' as metadata_json from documents"""
ORACLE["scan_entry_files"] = """select 'source=' || source as seq_id, sum(octet_length(encode(text)) + 1)::bigint as bytes, '.txt' as source_type
from documents group by source union all select 'source=none', 0, 'file not found'"""
ORACLE["import_job"] = """select 'lang=' || lang as folder, sum(octet_length(encode(text)) + 1)::bigint as bytes, 0::bigint as invalid,
  true as skipped from documents group by 1"""

# Quantize and split

ORACLE["quantize_relative"] = (
    with_(notes(), quantized())
    + "select seq_id, note_idx, q_start, q_end, bar as steps_per_bar, total_steps from q"
)
ORACLE["quantize_absolute"] = (
    with_(notes(), quantized(rate="10e0")) + "select seq_id, note_idx, q_start, q_end, total_steps from q"
)
REASONS = """reasons as (
  select seq_id,
    case when count(distinct num * 1000 + den) > 1 then 'multiple_time_signatures'
      when count(distinct qpm) > 1 then 'multiple_tempos'
      when min(num) <= 0 or not max(den) in (1, 2, 4, 8, 16, 32, 64, 128) then 'bad_time_signature'
      when (select min(start_time) from n where n.seq_id = ev.seq_id) < 0 then 'negative_time' end as reason
  from ev group by seq_id)"""
ORACLE["quantize_discards"] = with_(VARIED, REASONS) + "select * from reasons where reason is not null"
ORACLE["split_hop_seconds"] = (
    with_(
        notes(),
        "seg as (select *, floor(start_time / 1.5e0) * 1.5e0 as seg_start, (floor(start_time / 1.5e0) + 1) * 1.5e0 as seg_end from n)",
    )
    + timed("split")
)
ORACLE["split_hop_skip"] = (
    with_(
        notes(),
        "ticks as (select seq_id, unnest(range(0, cast(floor(max(start_time)) as bigint) + 1)) as cut from n group by seq_id)",
        """free as (select * from ticks where not exists (
  select 1 from n where n.seq_id = ticks.seq_id and n.start_time < cut and n.end_time > cut))""",
        "seg as (select n.*, cast(f.cut as double) as seg_start, null::double as seg_end from n asof join free f on n.seq_id = f.seq_id and n.start_time >= f.cut)",
    )
    + timed("split")
)
ORACLE["split_hop_bars"] = (
    with_(
        VARIED,
        """hops as (select seq_id, 2 * (arg_min(num, time) filter (num is not null) * 4e0 / arg_min(den, time) filter (den is not null)
    * 60e0 / arg_min(qpm, time) filter (qpm is not null)) as hop from ev group by seq_id)""",
        "seg as (select n.*, floor(start_time / hop) * hop as seg_start, (floor(start_time / hop) + 1) * hop as seg_end from n join hops on n.seq_id = hops.seq_id)",
    )
    + timed("split")
)
ORACLE["split_time_change"] = with_(VARIED, ALL_CUTS, SEGMENTS) + timed("change")
ORACLE["split_time_change_skip"] = with_(VARIED, FREE_CUTS, SEGMENTS) + timed("change")
ORACLE["filter_time_signature"] = (
    with_(VARIED, ALL_CUTS, SEGMENTS)
    + f"select seq_id, count(*) as notes, sum(pitch)::bigint as pitches from ({timed('change', 'seg where sig = 4004')}) group by seq_id"
)
ORACLE["split_events"] = (
    with_(
        VARIED,
        SILENCE.format(gap="6e0"),
        "bounds as (select distinct seq_id, seg_start from seg)",
        """every as (
  select seq_id, kind, time, qpm, num from ev
  union all select seq_id, 'control', time, null, null from pedal)""",
        "placed as (select e.*, b.seg_start from every e asof join bounds b on e.seq_id = b.seq_id and e.time >= b.seg_start)",
        """heads as (
  select b.seq_id, b.seg_start,
    (select arg_max(qpm, time) from ev where ev.seq_id = b.seq_id and ev.time <= b.seg_start and qpm is not null) as qpm,
    (select arg_max(num, time) from ev where ev.seq_id = b.seq_id and ev.time <= b.seg_start and num is not null) as num
  from bounds b)""",
        """handed as (
  select seq_id, seg_start, kind, time - seg_start as time, qpm, num from placed
    where kind = 'control' or time > seg_start
  union all select seq_id, seg_start, 'tempo', 0e0, qpm, null from heads where qpm is not null
  union all select seq_id, seg_start, 'time_signature', 0e0, null, num from heads where num is not null)""",
    )
    + """select seq_id || '#silence@' || cast(floor(seg_start * 1e6 + 0.5e0) as bigint) as seq_id, kind, count(*) as n,
  round(sum(time), 6) as times, coalesce(sum(qpm), 0) as qpm, coalesce(sum(num), 0)::bigint as num from handed group by 1, 2"""
)
EVENT_SUMS = """select seq_id, kind, count(*) as n, round(sum(time)::double, 6) as times, round(coalesce(sum(qpm), 0), 6) as qpm,
  coalesce(sum(num), 0)::bigint as num from handed group by 1, 2"""
EVERY = """every as (
  select seq_id, kind, time, qpm, num, null::int as instrument from ev
  union all select seq_id, 'control', time, null, null, instrument from pedal)"""
ORACLE["change_events"] = (
    with_(
        VARIED,
        FREE_CUTS,
        SEGMENTS,
        "live as (select distinct seq_id, seg_start from seg)",
        """lost as (select c.seq_id, c.time, case when q1 is distinct from q0 then qpm end as qpm, case when s1 is distinct from s0 then sig end as sig
  from (select f.seq_id, f.time, f.q1 as qpm, f.s1 as sig, q0, s0, q1, s1 from filled f
    where time = 0 or coalesce(q1, 120) <> coalesce(q0, 120) or coalesce(s1, 4004) <> coalesce(s0, 4004)) c
  where not exists (select 1 from cuts where cuts.seq_id = c.seq_id and cuts.time = c.time))""",
        """inner_ as (
  select seq_id, 'tempo' as kind, time, qpm, null::int as num from lost where qpm is not null
  union all select seq_id, 'time_signature', time, null, cast(floor(sig / 1000e0) as int) from lost where sig is not null
  union all select seq_id, 'control', time, null, null from pedal)""",
        """placed as (
  select i.seq_id, kind, i.time - coalesce(c.time, 0e0) as time, i.qpm, num, coalesce(c.time, 0e0) as seg_start
  from inner_ i asof left join cuts c on i.seq_id = c.seq_id and i.time >= c.time)""",
        """whole as (
  select * from placed
  union all select seq_id, 'tempo', 0e0, qpm, null, time from cuts where qpm is not null
  union all select seq_id, 'time_signature', 0e0, null, cast(floor(sig / 1000e0) as int), time from cuts where sig is not null)""",
        """handed as (
  select w.seq_id || '#change@' || cast(floor(w.seg_start * 1e6 + 0.5e0) as bigint) as seq_id, kind, time, qpm, num
  from whole w join live using (seq_id, seg_start))""",
    )
    + EVENT_SUMS
)
SETTLED = (
    VARIED,
    REASONS,
    EVERY,
    "sigs as (select seq_id, max(num) as num from ev where kind = 'time_signature' group by 1)",
    "fine as (select n.*, sigs.num from n join sigs using (seq_id) where seq_id in (select seq_id from reasons where reason is null))",
    quantized("fine", bar="(4e0 * num)"),
    "stepped as (select *, cast(floor(time * 4e0 + 0.5e0) as bigint) as step from every)",
)
ORACLE["slice_events"] = (
    with_(
        *SETTLED,
        slices("q"),
        "there as (select distinct seq_id as parent, k, s0, s1, num from s_cut where not short)",
        """handed as (
  select parent || '#slice' || k as seq_id, kind, step - s0 as time, qpm, e.num from there join stepped e on e.seq_id = parent
    and step >= s0 and step < s1 where kind = 'control' or step > s0
  union all select parent || '#slice' || k, 'tempo', 0, 60e0, null from there
  union all select parent || '#slice' || k, 'time_signature', 0, null, num from there)""",
    )
    + EVENT_SUMS
)
ORACLE["melody_events"] = (
    with_(
        *SETTLED,
        melodies("q"),
        "there as (select c.*, s.num from mel_check c join sigs s using (seq_id) where reason is null)",
        """handed as (
  select t.seq_id || '#melody' || t.instrument || '@' || m0 as seq_id, kind, step - m0 as time, qpm, e.num
    from there t join stepped e on e.seq_id = t.seq_id and step >= m0 and step < m0 + steps
      and case when kind = 'control' then e.instrument = t.instrument else step > m0 end
  union all select seq_id || '#melody' || instrument || '@' || m0, 'tempo', 0, 60e0, null from there
  union all select seq_id || '#melody' || instrument || '@' || m0, 'time_signature', 0, null, num from there)""",
    )
    + EVENT_SUMS
)
ORACLE["header_offsets"] = (
    with_(notes(), quantized(), slices("q"), melodies("q"))
    + """select distinct seq_id || '#slice' || k as seq_id, s0 / 4e0 as start_offset from s_cut where not short
union all select seq_id || '#melody' || instrument || '@' || m0, m0 / 4e0 from mel_check where reason is null"""
)
ORACLE["split_silence"] = with_(notes(), SILENCE.format(gap="3e0")) + timed("silence")

# Slices and melodies

ORACLE["slice_bars"] = with_(notes(), quantized(), slices("q", where="true")) + PER_SLICE
ORACLE["slice_drop_short"] = with_(notes(), quantized(), slices("q")) + PER_SLICE
ORACLE["slice_no_crop"] = (
    with_(notes(), quantized(), slices("q", hop=2, where="not short and not cropped and not cut_start")) + PER_SLICE
)
ORACLE["slice_shorter_count"] = (
    with_(notes(), quantized(), slices("q"))
    + "select count(distinct (seq_id, k)) as shorter_slices from s_all where short"
)
STEPPED = "select seq_id, q_start, q_end, pitch, velocity, total_steps from mel"
LIMITED = melodies("q", truncate=8, discard=12)
ORACLE["extract_melody"] = with_(notes(), quantized(), melodies("q")) + STEPPED
ORACLE["extract_melody_truncated"] = with_(notes(), quantized(), LIMITED) + STEPPED
ORACLE["melody_audit"] = (
    with_(notes(), quantized(), LIMITED)
    + """select metric, count(*) as value from (
  select coalesce(reason, 'output_sequences') as metric from mel_check
  union all select 'melodies_truncated' from mel_check where truncated) group by metric"""
)
ORACLE["melody_length_hist"] = (
    with_(notes(), quantized(), melodies("q"))
    + 'select kept_bars as bars, count(*) as "count" from mel_check where reason is null group by 1'
)
ORACLE["chain_process"] = (
    with_(
        VARIED,
        ALL_CUTS,
        SEGMENTS,
        """c as (
  select seq_id || '#change@' || cast(floor(seg_start * 1e6 + 0.5e0) as bigint) as seq_id, note_idx, pitch, velocity,
    instrument, is_drum, qpm, start_time - seg_start as start_time,
    case when seg_end < end_time then seg_end else end_time end - seg_start as end_time
  from seg where sig = 4004)""",
        "ok as (select *, min(start_time) over (partition by seq_id) as first_start from c)",
        "grid as (select * from ok where first_start >= 0)",
        quantized("grid", rate="(qpm / 60e0 * 4)"),
        melodies("q", min_bars=4),
        slices("mel", where="not short and not cropped"),
    )
    + PER_SLICE
)

ORACLE["process_written"] = ORACLE["chain_process"].replace("as total_steps from s group by", "as total_steps, 2::bigint as stated from s group by")

# Transforms

ORACLE["stretch"] = (
    with_(notes())
    + "select seq_id, note_idx, pitch, round(start_time * 1.5e0, 6) as start_time, round(end_time * 1.5e0, 6) as end_time from n"
)
ORACLE["sustain"] = (
    with_(
        VARIED,
        "values_ as (select seq_id, instrument, time, max(value) >= 64 as down from pedal group by 1, 2, 3)",
        """released as (
  select v.seq_id, v.instrument, v.time, v.down,
    (select min(w.time) from values_ w where w.seq_id = v.seq_id and w.instrument = v.instrument and w.time > v.time and not w.down)
      as until
  from values_ v)""",
        "ends as (select seq_id, max(end_time) as last_end from n group by 1)",
        """again as (
  select *, (select min(o.start_time) from n o where o.seq_id = n.seq_id and o.instrument = n.instrument and o.pitch = n.pitch
    and o.start_time > n.start_time) as restrike from n)""",
        """held as (
  select a.*, r.down, coalesce(r.until, e.last_end) as until, e.last_end
  from again a join ends e on a.seq_id = e.seq_id
    asof left join released r on a.seq_id = r.seq_id and a.instrument = r.instrument and a.end_time >= r.time)""",
    )
    + """select seq_id, note_idx, pitch, round(start_time, 6) as start_time,
  round(case when down then greatest(end_time, least(until, coalesce(restrike, until))) else end_time end, 6) as end_time
from held"""
)
MOVED = "case when is_drum then pitch else pitch + ({amount}) end"


def moved(amount: str) -> str:
    return MOVED.format(amount=amount)


ORACLE["transpose"] = (
    with_(notes())
    + f"select seq_id, note_idx, {moved('7')} as pitch from n where is_drum or pitch + 7 between 40 and 100"
)
IDS = """i as (
  select seq_id || '#silence@' || cast(floor(seg_start * 1e6 + 0.5e0) as bigint) as seq_id, note_idx, pitch, is_drum from seg)"""
SILENT = (notes(), SILENCE.format(gap="3e0"), IDS)
ORACLE["two_sources"] = (
    with_(
        *SILENT,
        """d as (select seq_id, count(*) as notes,
    case split_part(seq_id, '#', 1)::bigint % 2 when 1 then 'odd-full' else 'even-full' end as dataset from i group by seq_id)""",
    )
    + "select seq_id, notes, dataset, count(*) over (partition by dataset) as reported from d"
)
ORACLE["transpose_chords"] = (
    with_(*SILENT)
    + """select seq_id, cast(j - 1 as double) as time, ['D#', 'Am7', 'C#', 'N.C.'][j] as text
from (select distinct seq_id from i where is_drum or pitch + 3 between 60 and 72), range(1, 5) t(j)"""
)
ORACLE["stretch_events"] = (
    with_(VARIED, EVERY, "handed as (select seq_id, kind, time * 1.5e0 as time, qpm / 1.5e0 as qpm, num from every)") + EVENT_SUMS
)
ORACLE["transpose_strict"] = (
    with_(*SILENT)
    + f"""select seq_id, note_idx, {moved("-9")} as pitch from i
where seq_id not in (select seq_id from i where not is_drum and pitch - 9 not between 21 and 108)"""
)
ORACLE["transpose_audit"] = (
    with_(
        *SILENT,
        """d as (select seq_id, count(*) filter (not is_drum and pitch + 7 not between 40 and 100) as deleted, count(*) as total
  from i group by seq_id)""",
    )
    + """select count(*) filter (total = deleted) as skipped_due_to_range_exceeded,
  count(*) filter (total > deleted) as transpositions_generated, count(*) as deleted_count, sum(deleted)::bigint as deleted_sum,
  min(deleted) as deleted_min, max(deleted) as deleted_max, round(avg(deleted), 6) as deleted_mean from d"""
)

# Attributes

BINARY = "[5, 1, 2, 1, 3, 1, 2, 1, 4, 1, 2, 1, 3, 1, 2, 1]"
ATTRIBUTES = {
    "toussaint": f"""(select sum(({BINARY})[p % 16 + 1]) from (select distinct q_start as p from l where l.seq_id = g.seq_id
    and q_start < 64)) / (4e0 * 31)""",
    "note_density": """(select count(distinct floor(q_start * 12 / bar)) from l where l.seq_id = g.seq_id
    and floor(q_start * 12 / bar) < 48) / 48e0""",
    "pitch_range": "(max(pitch) - min(pitch)) / 88e0",
    "contour": "coalesce(avg(pitch - p1) / 88e0, 0)",
    "unique_notes_ratio": "count(distinct pitch) / count(*)",
    "unique_bigrams_ratio": "coalesce(count(distinct case when p1 is not null then (p1, pitch) end) / nullif(count(p1), 0), 0)",
    "unique_trigrams_ratio": "coalesce(count(distinct case when p2 is not null then (p2, p1, pitch) end) / nullif(count(p2), 0), 0)",
    "dynamic_range": "(max(velocity) - min(velocity)) / 127e0",
    "note_change_ratio": "coalesce(avg(case when p1 is not null then (p1 <> pitch)::int end), 0)",
    "ratio_note_off_steps": "(max(total_steps) - sum(q_end - q_start)) / max(total_steps)",
    "ratio_hold_note_steps": "(sum(q_end - q_start) - count(*)) / max(total_steps)",
    "repetitive_section_ratio": "sum(case when run_len >= 2 then 1 else 0 end) / count(*)",
    "len_longest_rep_section": "coalesce(max(case when run_len >= 2 then run_len end), 0)",
}
BEFORE = """b as (
  select *, lag(pitch) over w as p1, lag(pitch, 2) over w as p2 from l window w as (partition by seq_id order by q_start)),
r as (select *, sum((p1 is distinct from pitch)::int) over (partition by seq_id order by q_start) as run from b),
g as (select *, count(*) over (partition by seq_id, run) as run_len from r)"""
FEW_NAMES = {
    "unique_bigrams_ratio",
    "unique_trigrams_ratio",
    "note_change_ratio",
    "repetitive_section_ratio",
    "len_longest_rep_section",
}
SHORT_NAMES = {
    "unique_notes_ratio": "unique_notes",
    "unique_bigrams_ratio": "bigrams",
    "unique_trigrams_ratio": "trigrams",
    "note_change_ratio": "note_change",
    "ratio_note_off_steps": "note_off",
    "ratio_hold_note_steps": "hold",
    "repetitive_section_ratio": "rep_ratio",
    "len_longest_rep_section": "longest_rep",
}


def attribute_select(names: list[str], source: str = "g") -> str:
    columns = [f"round(cast({ATTRIBUTES[a]} as double), 5) as {a}" for a in names]
    return f"select seq_id, {', '.join(columns)} from {source} group by seq_id"


def sliced(pitch: str = "21 + k % 88") -> tuple[str, ...]:
    return notes(pitch), quantized(), slices("q"), line("s")


for _name in ATTRIBUTES:
    ORACLE[f"attr_{SHORT_NAMES.get(_name, _name)}"] = with_(
        *sliced(FEW if _name in FEW_NAMES else "21 + k % 88"), BEFORE
    ) + attribute_select([_name])
ORACLE["attributes_all"] = with_(notes(FEW), quantized(), line("q"), BEFORE) + attribute_select(list(ATTRIBUTES))
ORACLE["attributes_written"] = (
    with_(notes(), quantized(), line("q"), BEFORE, f"a as ({attribute_select(['contour', 'pitch_range'])})")
    + "select seq_id, 'events/' || seq_id || '.mid' as filepath, contour, pitch_range from a"
)
ORACLE["custom_attribute"] = (
    with_(*sliced()) + "select seq_id, round(avg(velocity) * 0.5e0, 4) as mean_velocity from l group by seq_id"
)
ORACLE["attr_histogram"] = (
    with_(
        *sliced(),
        BEFORE,
        f"a as ({attribute_select(['toussaint', 'pitch_range', 'contour'])})",
        """v as (
  select 'toussaint' as metric, toussaint as v from a union all select 'pitch_range', pitch_range from a
  union all select 'contour', contour from a)""",
        """ranges as (
  select metric, min(v) - case when min(v) = max(v) then 0.5 else 0 end as lo,
    max(v) + case when min(v) = max(v) then 0.5 else 0 end as hi from v group by metric)""",
        "grid as (select metric, lo, hi, bins, unnest(range(0, bins)) as bin from ranges, (values (30), (40), (50)) t(bins))",
        """hits as (
  select metric, bins, least(cast(floor((v - lo) / (hi - lo) * bins) as int), bins - 1) as bin, count(*) as c
  from v join ranges using (metric), (values (30), (40), (50)) t(bins) group by all)""",
    )
    + """select metric, bins, cast(bin as int) as bin, round(lo + bin * ((hi - lo) / bins), 6) as lo,
  round(lo + (bin + 1) * ((hi - lo) / bins), 6) as hi, coalesce(c, 0) as "count"
from grid left join hits using (metric, bins, bin)"""
)

ORACLE["histogram_stored"] = ORACLE["attr_histogram"]

# Augment and split

AMOUNT = f"-12 + cast(floor({uniform('amount')} * 24) as int)"
GATE = f"{uniform('gate')} > 0.3e0"
ORACLE["augment_gate"] = (
    with_(notes()) + f"select distinct seq_id, {uniform('gate')} > 0.7e0 as augmented from n"
)
ORACLE["augment_transpose"] = (
    with_(notes(), f"d as (select *, case when {GATE} then {AMOUNT} end as a from n)")
    + f"select seq_id, note_idx, {moved('coalesce(a, 0)')} as pitch from d where a is null or is_drum or pitch + a between 21 and 108"
)
ORACLE["augment_clamped"] = (
    with_(
        *SILENT,
        """b as (select seq_id, -least(min(pitch) filter (not is_drum) - 21, 12) as lo, least(108 - max(pitch) filter (not is_drum), 12) as hi
  from i group by seq_id)""",
        f"""d as (select i.*, case when {GATE.replace("seq_id", "i.seq_id")} and lo <= hi then
    case when lo = hi then lo else lo + cast(floor({uniform("amount", key="i.seq_id")} * (hi - lo)) as int) end end as a
  from i join b on i.seq_id = b.seq_id)""",
    )
    + f"select seq_id, note_idx, cast({moved('coalesce(a, 0)')} as int) as pitch from d"
)
NARROW = (
    *SILENT,
    f"d as (select *, case when {GATE} then {AMOUNT} end as a from i)",
    "e as (select *, a is not null and not is_drum and pitch + a not between 50 and 80 as lost from d)",
    "f as (select *, count(*) filter (not lost) over (partition by seq_id) as left_, count(*) filter (lost) over (partition by seq_id) as lost_n from e)",
)
ORACLE["augment_append"] = (
    with_(*NARROW)
    + f"""select seq_id, note_idx, pitch from f where left_ > 0
union all select seq_id || '#transposed', note_idx, {moved("a")} from f where left_ > 0 and a is not null and not lost"""
)
ORACLE["augment_audit"] = (
    with_(*NARROW, "p as (select seq_id, any_value(a) as a, max(left_) as left_, max(lost_n) as lost_n from f group by seq_id)")
    + """select count(*) as input_sequences, count(*) filter (left_ > 0) as output_sequences,
  count(*) filter (a is not null) as augmented_sequences, count(*) filter (left_ = 0) as skipped_due_to_range_exceeded,
  0::bigint as skipped_invalid_range, count(a) as deleted_count, (sum(lost_n) filter (a is not null))::bigint as deleted_sum,
  min(lost_n) filter (a is not null) as deleted_min, max(lost_n) filter (a is not null) as deleted_max from p"""
)
ORACLE["split_dataset"] = with_(notes()) + f"select distinct seq_id, {SPLIT} as split from n"
ORACLE["split_augment"] = (
    with_(notes(), f"d as (select *, case when {GATE} and {SPLIT} <> 'test' then {AMOUNT} end as a from n)")
    + f"select seq_id, note_idx, {moved('coalesce(a, 0)')} as pitch from d where a is null or is_drum or pitch + a between 21 and 108"
)
ORACLE["split_report"] = (
    with_(notes(), f"d as (select distinct seq_id, {SPLIT} as split from n)")
    + """select t.split, count(d.seq_id) as actual, cast(floor((select count(*) from d) * t.ratio) as bigint) as expected
from (values ('train', 0.7e0), ('validation', 0.2e0), ('test', 0.1e0)) t(split, ratio) left join d on d.split = t.split
group by t.split, t.ratio"""
)

# Represent


def tokens(source: str, name: str = "tok", chunk: int = 1 << 30) -> str:
    """Tokens of every step, found by looking up the last onset at or before the step."""
    return f"""{name}_step as (
  select seq_id, unnest(range(0, max(total_steps))) as step from {source} group by seq_id),
{name}_all as (
  select s.seq_id, s.step, case when l.q_start = s.step then l.pitch when l.q_end > s.step then 128 else 129 end as token, l.pitch
  from {name}_step s asof left join {source} l on s.seq_id = l.seq_id and s.step >= l.q_start),
{name}_sum as (
  select seq_id, cast(floor(step / {chunk}e0) as bigint) as chunk, string_agg(token::varchar, ',' order by step) as tokens, count(*) as size,
    max(case when token = 128 and step = cast(floor(step / {chunk}e0) as bigint) * {chunk} then pitch end) as held
  from {name}_all group by 1, 2),
{name} as (select * from {name}_sum)"""


ORACLE["encode_pitch_seq"] = with_(*sliced(), tokens("l")) + "select seq_id, tokens from tok"
ORACLE["encode_whole"] = with_(notes(), quantized(), line("q"), tokens("l")) + "select seq_id, tokens from tok"
LONG = with_(notes(), quantized(), line("q"), tokens("l", chunk=256))
ORACLE["encode_long"] = LONG + "select seq_id, chunk, held, tokens from tok"
ORACLE["distinct_long"] = LONG + "select seq_id, chunk, tokens, 2::bigint as copies from tok"
ORACLE["decode_long"] = with_(notes(), quantized(), line("q")) + "select seq_id, q_start, q_end, pitch from l"
ORACLE["encode_files"] = (
    with_(
        VARIED,
        "stated as (select seq_id, time from ev union all select seq_id, time from pedal)",
        "e as (select seq_id, count(*) as events, round(sum(time), 3) as times from stated group by seq_id)",
    )
    + """select seq_id, count(*) as notes, sum(pitch)::bigint as pitches, round(sum(start_time), 3) as starts,
  round(sum(end_time), 3) as ends, any_value(events) as events, any_value(times) as times from n join e using (seq_id) group by seq_id"""
)
ORACLE["custom_format"] = (
    with_(notes())
    + """select seq_id, row_number() over (partition by seq_id order by note_idx) - 1 as note_idx, pitch,
  round(start_time, 6) as start_time, round(end_time, 6) as end_time from n"""
)
ORACLE["write_splits"] = (
    with_(*sliced(), tokens("l"))
    + f"select seq_id, {SPLIT} as split, tokens from tok"
)
ORACLE["encode_with_context"] = (
    with_(*sliced(), BEFORE, tokens("l"), f"a as ({attribute_select(['pitch_range', 'contour'])})")
    + """select seq_id, tokens, round(pitch_range::float::double, 5) as pitch_range, round(contour::float::double, 5) as contour
from tok join a using (seq_id)"""
)
ORACLE["decode_with_context"] = (
    with_(*sliced(), BEFORE, f"a as ({attribute_select(['pitch_range', 'contour'])})")
    + """select seq_id, 64::bigint as total_steps, count(*) as notes, sum(pitch)::bigint as pitches,
  round(any_value(pitch_range)::float::double, 5) as pitch_range, round(any_value(contour)::float::double, 5) as contour
from l join a using (seq_id) group by seq_id"""
)
ORACLE["parse_features"] = (
    with_(*sliced(), BEFORE, f"a as ({attribute_select(['contour'])})")
    + "select seq_id, round(contour::float::double, 5) as contour, -1e0 as toussaint from a"
)
ORACLE["parse_fixed_length"] = (
    with_(notes(), quantized(), line("q"), tokens("l"))
    + "select seq_id, cast(size as int) as actual_length, size = 718 as fits from tok"
)
ORACLE["decode_pitch_seq"] = (
    with_(notes(), quantized(), melodies("q")) + "select seq_id, q_start, q_end, pitch from mel"
)

# Distinct and counters

COUNTED = with_(notes()) + "select seq_id, count(*) as notes from n group by seq_id"
ORACLE["distinct_sequences"] = (
    with_(VARIED, "c as (select seq_id, count(*) as notes from n group by seq_id)")
    + """select seq_id, any_value(notes) as notes, count(*) filter (kind = 'tempo') as tempos,
  2 * count(*) filter (kind = 'time_signature') as signatures from c join ev using (seq_id) group by seq_id"""
)
ORACLE["distinct_content"] = COUNTED
ORACLE["distinct_examples"] = (
    with_(
        notes(FEW),
        quantized(),
        slices("q", size=1, where="true", extra=", is_drum"),
        """b as (select seq_id, -least(min(pitch) - 21, 3) as lo, least(108 - max(pitch), 3) as hi
  from s where not is_drum group by seq_id)""",
        f"""d as (select s.*, {SPLIT.replace("seq_id", "s.seq_id")} as split,
    case when {uniform("gate", key="s.seq_id")} > 0.7e0 and lo <= hi then
    case when lo = hi then lo else lo + cast(floor({uniform("amount", key="s.seq_id")} * (hi - lo)) as int) end end as a
  from s left join b on s.seq_id = b.seq_id)""",
        """t as (select seq_id, note_idx, split, q_start, q_end, velocity, bar, total_steps,
    pitch + case when split = 'train' and not is_drum then coalesce(a, 0) else 0 end as pitch from d)""",
        line("t"),
        tokens("l"),
        "names as (select distinct seq_id, split from t)",
    )
    + "select split, tokens, min(seq_id) as seq_id, count(*) as copies from tok join names using (seq_id) group by split, tokens"
)
ORACLE["duplicate_report"] = """select count(*) as total, count(distinct text) as distinct_count,
  count(*) - count(distinct text) as duplicates, round(100e0 * (count(*) - count(distinct text)) / count(*), 6) as duplicate_percent
from documents"""
ORACLE["count_elements"] = (
    with_(notes()) + "select instrument, count(*) as total_elements from n group by instrument"
)
ORACLE["stage_audit"] = (
    with_(VARIED, REASONS)
    + """select 'quantizer' as stage, 'input_sequences' as metric, count(*) as value from reasons
union all select 'quantizer', 'output_sequences', count(*) from reasons where reason is null
union all select 'quantizer', 'sequences_discarded_' || r, (select count(*) from reasons where reason = r)
  from (values ('multiple_time_signatures'), ('multiple_tempos'), ('bad_time_signature'), ('negative_time')) t(r)"""
)

# Loader

STABLE = "row_number() over (order by md5('stable:' || o_orderkey), o_orderkey) - 1 as position"
PARSED = f"select o_orderkey, o_orderstatus, o_totalprice, 0 as epoch, {STABLE} from orders"
ORACLE["loader_parse"] = PARSED
ORACLE["loader_cache"] = PARSED
ORACLE["loader_map"] = "select o_orderkey, cast(floor(o_totalprice / 1000) as bigint) as thousands, 0 as epoch, " + STABLE + " from orders"
ORACLE["loader_filter"] = PARSED + " where o_orderstatus = 'F'"


def placed(key: str, epochs: int = 1, size: int = 64) -> str:
    return f"""p as (
  select o_orderkey, cast(epoch as int) as epoch, row_number() over (order by epoch, md5({key}), o_orderkey) - 1 as position
  from orders, range({epochs}) t(epoch)),
b as (select o_orderkey, epoch, cast(floor(position / {size}e0) as bigint) as batch_id, cast(position % {size} as int) as pos_in_batch from p)"""


ORACLE["loader_shuffle"] = with_(placed("'7:' || o_orderkey")) + "select * from b"
ORACLE["loader_repeat"] = (
    with_(placed("'7:' || epoch || ':' || o_orderkey", 3)) + "select * from b where batch_id < (select floor(count(*) / 64e0) from p)"
)
ORACLE["loader_batch"] = (
    with_(placed("'stable:' || o_orderkey", size=50))
    + "select batch_id, string_agg(o_orderkey::varchar, ',' order by pos_in_batch) as keys from b group by batch_id"
)
ORACLE["loader_epochs"] = with_(placed("'7:' || o_orderkey", 3, 50)) + "select * from b"
ORACLE["loader_shuffle_unbatched"] = (
    "select o_orderkey, row_number() over (order by md5('7:' || o_orderkey), o_orderkey) - 1 as position from orders"
)
ORACLE["loader_examples"] = (
    with_(
        notes(FEW),
        quantized(),
        slices("q", size=1, where="true"),
        line("s"),
        tokens("l"),
        "d as (select min(seq_id) as seq_id, tokens from tok group by tokens)",
        "p as (select *, row_number() over (order by md5('3:' || seq_id), seq_id) - 1 as position from d)",
    )
    + """select seq_id, tokens, cast(floor(position / 16e0) as bigint) as batch_id, cast(position % 16 as int) as pos_in_batch from p"""
)
