"""Gap sessionisation of clicks, in lockstep over numpy arrays.

Clicks lie in order of client, time and id, dealt into ranges of rows, so that a
client of any size spreads over many tasks.  A click after a final one, or after a
gap, starts a session whatever came before.  Between two such clicks lies an
island, within which only the greatest length splits, click after click.  All
islands of a task are laid on one time line, one after the other with more than
that length between them: its points are composite keys of island and time.
Every island that isn't done moves to its next session in one step, by one
``searchsorted`` of all their keys.  There is no loop over clients or sessions.

Only the head of a range, up to the first click that starts a session for
certain, depends on the range before.  Ranges hand on the session that is open at
their end, by a join on the number of the range: one round for all heads,
and one more for each range that is head throughout, as nothing in it starts a
session for certain.  Sessions that cross ranges are put together from their
pieces.  Nothing goes through the driver but a count of open heads.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from .common import spool

#: Microseconds after which a click is late, a session has a gap, and a session is too long; what makes a purchase final.
MINUTE = 60_000_000
LATE, GAP, LENGTH = 60 * MINUTE, 5 * MINUTE, 120 * MINUTE
FINAL_KIND, FINAL_VALUE = "purchase", 60

#: Rows of a range: 9 MB of arrays, some 100 MB with what is made of them.
ROWS = 1 << 18

REASONS = (None, "end", "gap", "length")

PIECE = "client_id long, session_id long, start_us long, end_us long, n_clicks long, n_late long, value_cents long, final boolean, closed_by string, path array<long>"
#: What a range hands on: the last click's client, with the session that is open there and its last timely click, if there is one.
EXIT = "client_id long, session_id long, start_us long, end_us long, final boolean"
HEAD = "client_id long, us array<long>, late array<boolean>, click_id array<long>, cents array<long>, final boolean, after string"
MADE = f"pid int, whole boolean, piece struct<{PIECE.replace(' ', ':').replace(',:', ',')}>, exit struct<{EXIT.replace(' ', ':').replace(',:', ',')}>, head struct<{HEAD.replace(' ', ':').replace(',:', ',')}>"


def _cut(seg, us, late, ids, cents, final, forced, entered, entered_us):
    """Pieces of sessions, and for each its segment.

    Rows lie in order of segment, time and id, late ones after timely ones of one time.
    ``forced`` marks timely rows that start a session (with the index of the reason),
    -1 elsewhere.  A segment that is ``entered`` continues a session that started at
    ``entered_us``; its first piece belongs to that.
    """
    import numpy as np

    n, k = len(seg), len(entered)
    tm = np.flatnonzero(~late)
    t, s, reason = us[tm], seg[tm], forced[tm].astype(np.int8)
    first = np.ones(len(tm), bool)
    first[1:] = s[1:] != s[:-1]
    goes_on = first & (reason < 0) & entered[s]
    isl = np.flatnonzero(first | (reason >= 0))
    isl_end = np.append(isl[1:], len(tm))
    starts = np.zeros(len(tm), bool)
    starts[isl] = ~goes_on[isl]
    reason[isl] = np.maximum(reason[isl], 0)
    if len(isl):
        origin = np.where(goes_on[isl], entered_us[s[isl]], t[isl])
        island = np.repeat(np.arange(len(isl)), isl_end - isl)
        line = t - origin[island]
        room = line[isl_end - 1] + LENGTH + 1
        base = np.cumsum(room) - room
        line += base[island]
        here, open_ = base.copy(), np.arange(len(isl))
        while len(open_):
            to = np.searchsorted(line, here[open_] + LENGTH, "right")
            more = to < isl_end[open_]
            open_, to = open_[more], to[more]
            starts[to], reason[to] = True, REASONS.index("length")
            here[open_] = line[to]
    seg_first = np.searchsorted(seg, np.arange(k))
    carried = np.flatnonzero(entered)
    st = np.flatnonzero(starts)
    pos = np.concatenate([seg_first[carried], tm[st]])
    order = np.lexsort((np.concatenate([np.zeros(len(carried), int), np.ones(len(st), int)]), pos))
    # a carried piece of a segment without rows, or whose first row starts a session, has none of its own
    pos, owner, opens = pos[order], np.concatenate([carried, s[st]])[order], np.concatenate([np.full(len(carried), -1), st])[order]
    of_row = np.searchsorted(pos, np.arange(n), "right") - 1
    at_home = np.zeros(n, bool)
    if len(pos):
        at_home = (of_row >= 0) & (owner[np.maximum(of_row, 0)] == seg)
    m = len(pos)
    clicks = np.bincount(of_row[tm], minlength=m) if m else np.zeros(0, int)
    n_late = np.bincount(of_row[late & at_home], minlength=m) if m else np.zeros(0, int)
    upto = np.cumsum(clicks)
    total = np.concatenate([[0], np.cumsum(cents[tm])])
    last = np.where(clicks > 0, upto - 1, -1)
    closed = np.zeros(m, np.int8)
    nxt = np.flatnonzero(owner[1:] == owner[:-1])
    closed[nxt] = reason[opens[nxt + 1]]
    pick = lambda values, at, none: np.where(at >= 0, values[np.maximum(at, 0)], none) if len(values) else np.full(len(at), none)
    out = {
        "session_id": pick(ids[tm], opens, 0), "start_us": pick(t, opens, 0), "end_us": pick(t, last, 0), "n_clicks": clicks, "n_late": n_late,
        "value_cents": total[upto] - total[upto - clicks], "final": pick(final[tm], last, False), "closed_by": closed, "opens": opens >= 0,
    }
    return owner, out, np.concatenate([[0], upto]), ids[tm]


def _arrow(fields: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    return pa.struct([(f.split()[0], kinds[f.split()[1]]) for f in fields.split(", ")])


def _batch(pid, whole=None, piece=None, exit_=None, head=None):
    """An Arrow batch of MADE with one of the three structs."""
    import pyarrow as pa

    n = len(pid)
    parts = [x if x is not None else pa.nulls(n, _arrow(f)) for x, f in ((piece, PIECE), (exit_, EXIT), (head, HEAD))]
    return pa.RecordBatch.from_arrays([pa.array(pid, pa.int32()), pa.array(whole if whole is not None else [None] * n, pa.bool_()), *parts], ["pid", "whole", "piece", "exit", "head"])


def _pieces(client, session, start, end, out, bounds, ids, closed):
    """The struct array of pieces."""
    import numpy as np
    import pyarrow as pa

    none = out["n_clicks"] == 0
    cols = [
        pa.array(client, pa.int64()), pa.array(session, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64(), mask=none), pa.array(out["n_clicks"], pa.int64()), pa.array(out["n_late"], pa.int64()),
        pa.array(out["value_cents"], pa.int64()), pa.array(out["final"].astype(bool), pa.bool_(), mask=none), pa.array([REASONS[i] for i in closed.tolist()], pa.string()), pa.ListArray.from_arrays(pa.array(np.asarray(bounds), pa.int32()), pa.array(ids, pa.int64())),
    ]
    return pa.StructArray.from_arrays(cols, fields=list(_arrow(PIECE)))


def _ranged(batches: Iterator) -> Iterator:
    """Of one range: its sessions, its head, and what it hands on."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    of = lambda c: rows.column(c).to_numpy()
    client, us, late, ids, cents, final = (of(c) for c in ("client_id", "us", "late", "click_id", "cents", "final"))
    tm = np.flatnonzero(~late)
    same = client[tm[1:]] == client[tm[:-1]]
    forced = np.full(len(client), -1, np.int8)
    forced[tm[1:]] = np.where(same & final[tm[:-1]], 1, np.where(same & (us[tm[1:]] - us[tm[:-1]] >= GAP), 2, -1))
    changes = np.flatnonzero(client[1:] != client[:-1]) + 1
    sure = np.flatnonzero(forced > 0)
    h = min(changes[0] if len(changes) else len(client), sure[0] if len(sure) else len(client))
    after = None if h == len(client) else "over" if client[h] != client[0] else REASONS[forced[h]]

    timely = np.flatnonzero(~late[:h])
    one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, h], pa.int32()), pa.array(x[:h], kind))
    ends = [pa.array([bool(final[timely[-1]]) if len(timely) else None], pa.bool_()), pa.array([after], pa.string())]
    head = [pa.array([client[0]], pa.int64()), one(us, pa.int64()), one(late, pa.bool_()), one(ids, pa.int64()), one(cents, pa.int64()), *ends]
    yield _batch([pid], head=pa.StructArray.from_arrays(head, fields=list(_arrow(HEAD))))
    if h == len(client):
        return

    seg = np.concatenate([[0], np.cumsum(client[h + 1 :] != client[h:-1])])
    of_seg = client[h:][np.searchsorted(seg, np.arange(seg[-1] + 1))]
    no = np.zeros(len(of_seg), bool)
    owner, out, bounds, path = _cut(seg, us[h:], late[h:], ids[h:], cents[h:], final[h:], forced[h:], no, no.astype(np.int64))
    if len(owner):
        whole = np.append(np.ones(len(owner) - 1, bool), owner[-1] < seg[-1])  # all but the session that is open at the end
        yield _batch(np.full(len(owner), pid), whole, piece=_pieces(of_seg[owner], out["session_id"], out["start_us"], out["end_us"], out, bounds, path, out["closed_by"]))
    open_ = len(owner) and owner[-1] == seg[-1]
    got = {"client_id": client[-1], "session_id": None, "start_us": None, "end_us": None, "final": None} | ({c: out[c][-1] for c in ("session_id", "start_us", "end_us", "final")} if open_ else {})
    yield _batch([pid], exit_=pa.array([{k: v if v is None else v.item() for k, v in got.items()}], _arrow(EXIT)))


def _entered(batches: Iterator) -> Iterator:
    """Of heads with what came before them: pieces of sessions, and what ranges hand on that are head throughout."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        if not b.num_rows:
            continue
        head, entry = b.column("head"), b.column("entry")
        got = lambda x, c: x.field(c).to_pylist()
        pid, hc, ec = b.column("pid").to_numpy(), got(head, "client_id"), got(entry, "client_id")
        session, start, end, fin = (got(entry, c) for c in ("session_id", "start_us", "end_us", "final"))
        known = np.array([c is None or (c == e and x is not None) for c, e, x in zip(hc, ec, session, strict=True)])
        entered = known & np.array([x is not None for x in session])
        lists = {c: head.field(c) for c in ("us", "late", "click_id", "cents")}
        sizes = np.array([0 if c is None else len(x) for c, x in zip(hc, lists["us"], strict=True)])
        seg = np.repeat(np.arange(len(pid)), sizes)
        us, late, ids, cents = (lists[c].flatten().to_numpy(zero_copy_only=False) for c in ("us", "late", "click_id", "cents"))
        forced = np.full(len(us), -1, np.int8)
        tm = np.flatnonzero(~late)
        lead = tm[np.flatnonzero(np.append(True, seg[tm[1:]] != seg[tm[:-1]]))] if len(tm) else tm
        entered_us, end_us, was_final = (np.array([v if v is not None and e else 0 for v, e in zip(x, entered, strict=True)], np.int64) for x in (start, end, fin))
        who = seg[lead]
        forced[lead] = np.where(~entered[who], -1, np.where(was_final[who] > 0, 1, np.where(us[lead] - end_us[who] >= GAP, 2, np.where(us[lead] - entered_us[who] > LENGTH, 3, -1))))
        final = np.zeros(len(us), bool)
        tail = tm[np.flatnonzero(np.append(seg[tm[1:]] != seg[tm[:-1]], True))] if len(tm) else tm
        final[tail] = [bool(head.field("final")[int(i)].as_py()) for i in seg[tail]]
        owner, out, bounds, path = _cut(seg, us, late, ids, cents, final, forced, entered, entered_us)
        opens = out["opens"]
        key = lambda own, carried: np.where(opens, own, np.array([x or 0 for x in carried], np.int64)[owner])
        sid, first = key(out["session_id"], session), key(out["start_us"], start)
        client = np.array([c if c is not None else e for c, e in zip(hc, ec, strict=True)], object)
        after = got(head, "after")
        last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
        closed = np.where(last, np.array([REASONS.index(a) if a in REASONS else 0 for a in after])[owner], out["closed_by"]) if len(owner) else out["closed_by"]
        if len(owner):
            yield _batch(pid[owner], np.zeros(len(owner), bool), piece=_pieces(client[owner], sid, first, out["end_us"], out, bounds, path, closed))
        exits = {int(i): {"client_id": client[i], "session_id": None, "start_us": None, "end_us": None, "final": None} for i, a in enumerate(after) if a is None}
        for j in np.flatnonzero(last):
            if (i := int(owner[j])) in exits:
                some = out["n_clicks"][j] > 0
                exits[i] |= {"session_id": int(sid[j]), "start_us": int(first[j]), "end_us": int(out["end_us"][j]) if some else end[i], "final": bool(out["final"][j]) if some else fin[i]}
        if exits:
            yield _batch(pid[list(exits)], exit_=pa.array(list(exits.values()), _arrow(EXIT)))


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a time; one without a zone counts as UTC, whatever the session's zone is."""
    c = F.col(name)
    if not isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.unix_micros(c)
    of_day = (F.hour(c) * 60 + F.minute(c)).cast("long") * MINUTE + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return F.unix_date(c.cast("date")).cast("long") * (1440 * MINUTE) + of_day


def cents_of(value: Column) -> Column:
    """floor(100 * value + 0.5); 0 for null and for what isn't finite, at most 2^62 on either side."""
    whole = F.floor(F.greatest(F.lit(-4e18), F.least(F.lit(4e18), 100 * value + 0.5)))
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), F.lit(0)).otherwise(whole.cast("long")).cast("long")


def clean(clicks: DataFrame) -> DataFrame:
    """client_id, us, late, click_id, cents, final: one row per click_id of those that have a click_id, client_id and ts.

    Where rows of one id differ, the one with the least (ts, client_id, arrived_at,
    kind, value) counts, nulls first.  A click without arrived_at is timely.
    """
    us, arrived = micros(clicks, "ts"), micros(clicks, "arrived_at")
    some = clicks.where("click_id IS NOT NULL AND client_id IS NOT NULL AND ts IS NOT NULL").select("click_id", F.struct(us.alias("us"), "client_id", arrived.alias("arrived"), "kind", "value").alias("x"))
    x = some.groupBy("click_id").agg(F.min("x").alias("x"))
    final = F.coalesce((F.col("x.kind") == FINAL_KIND) & (F.col("x.value") >= FINAL_VALUE), F.lit(False))
    late = F.coalesce(F.col("x.arrived") - F.col("x.us") > LATE, F.lit(False))
    return x.select("x.client_id", "x.us", late.alias("late"), "click_id", cents_of(F.col("x.value")).alias("cents"), final.alias("final"))


def sessionise(clicks: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per session: client_id, session_id, start_us, end_us, n_clicks, n_late, value_cents, closed_by, path.

    ``path`` has the session's click ids in order of time and id; a session's ids are
    in one row, as its digest needs them.  Late clicks before a client's first session
    count nowhere; a client with late clicks only has no session.  Empty tables give
    no rows; extra columns don't matter.  Ranges of ``rows`` clicks are worked on
    when this is called.
    """
    spark = clicks.sparkSession
    taken = spool(clean(clicks), "clicks")
    order = ["client_id", "us", "late", "click_id"]
    made = spool(taken.repartitionByRange(taken.count() // rows + 1, *order).sortWithinPartitions(*order).mapInArrow(_ranged, MADE), "ranges")

    exits = made.where("exit IS NOT NULL").select("pid", "exit").unionByName(spark.range(1).select(F.lit(-1).alias("pid"), F.lit(None).cast(made.schema["exit"].dataType).alias("exit")))
    last = made.agg(F.max("pid")).first()[0]
    heads = made.where("head IS NOT NULL").select("pid", "head")
    heads = spark.range(-1 if last is None else last + 1).select(F.col("id").cast("int").alias("pid")).join(heads.hint("merge"), "pid", "left") if last is not None else heads
    parts = [made.where("piece IS NOT NULL AND NOT whole").select("pid", "piece")]
    left = -1 if last is None else last + 1
    while left > 0:
        here = heads.join(exits.select((F.col("pid") + 1).alias("pid"), F.col("exit").alias("entry")).hint("merge"), "pid")
        done = spool(here.mapInArrow(_entered, MADE), "entered")
        parts.append(done.where("piece IS NOT NULL").select("pid", "piece"))
        heads = spool(heads.join(exits.select((F.col("pid") + 1).alias("pid")).hint("merge"), "pid", "left_anti"), "heads")
        exits, left = done.where("exit IS NOT NULL").select("pid", "exit"), heads.count()

    whole = made.where("piece IS NOT NULL AND whole").select("piece.*")
    pieces = parts[0]
    for p in parts[1:]:
        pieces = pieces.unionByName(p)
    crossing = pieces.select("pid", "piece.*").groupBy("client_id", "session_id").agg(
        F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), *(F.sum(c).alias(c) for c in ("n_clicks", "n_late", "value_cents")),
        F.max_by("final", F.when(F.col("n_clicks") > 0, F.col("pid"))).alias("final"), F.max("closed_by").alias("closed_by"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("n_clicks") > 0, F.struct("pid", "path")))), lambda x: x["path"])).alias("path"),
    )
    closed = F.coalesce("closed_by", F.when(F.col("final"), "end").otherwise("none"))
    return whole.unionByName(crossing).select("client_id", "session_id", "start_us", "end_us", "n_clicks", "n_late", "value_cents", closed.alias("closed_by"), "path")
