"""HJ 212 environmental frames: reassembly, checking, factor points."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagflow.functions import text as X
from tagflow.functions import values as V
from tagflow.functions.stages import compute_once, join_on, let
from tagflow.operators.decode import crc16
from tagflow.operators.intervals import first_disjoint, fixed
from tagflow.operators.ordered import Ordered

NOISE = "bytes outside a frame"

# Value suffixes of a factor (fixed values); other suffixes are no numbers.
VALUE_SUFFIXES = (
    "Rtd", "Avg", "Min", "Max", "Cou",
    "ZsRtd", "ZsAvg", "ZsMin", "ZsMax", "ZsCou",
)
# Command codes and the grain of their data (fixed values).
GRAINS = {"2011": "realtime", "2051": "minute", "2061": "hour", "2031": "day"}


def declared_length(head: bytes) -> int | None:
    """Length field of a frame head; None when it is no usable number."""
    if not re.fullmatch(rb"\+?[0-9]+", head):
        return None
    return int(head) or None


def feed(buffer: bytes, received: bytes) -> tuple[bytes, list[tuple[bytes, str | None]]]:
    """Append one received segment; returns the rest to keep and (bytes, None) of whole
    frames and (bytes, reason) of what lies outside frames, in order.

    The rest is an unfinished frame, whose head bounds its length, or a lone ``#``.
    """
    data = buffer + received
    out: list[tuple[bytes, str | None]] = []
    done = at = 0  # all before `done` is given out; the search goes on at `at`

    def skip(to: int) -> None:
        if to > done:
            out.append((data[done:to], NOISE))

    while True:
        at = data.find(b"##", at)
        if at < 0:
            at = len(data) - data.endswith(b"#")
            break
        if len(data) - at < 6:
            break
        length = declared_length(data[at + 2 : at + 6])
        if length is None:
            at += 2 if data[at + 2 : at + 3] != b"#" else 1
            continue
        end = at + length + 12
        if len(data) < end:
            break
        skip(at)
        out.append((data[at:end], None))
        done = at = end
    skip(at)
    return data[at:], out


# Bytes of a connection looked at together, and how far a frame may reach beyond: the
# longest declared length (9999) with its head, checksum and line end.
BLOCK = 1 << 15
LONGEST = 9_999 + 12
# Bytes of a block that heads are looked for in together.
PIECE = 512
# A head that can be a frame's: at least one digit, a sign in front of three.
_HEAD = r"(?=##(?:\+[0-9]{3}|[0-9]{4}))"
# Kinds of marks along a connection, in their order at one place.
_END, _SEGMENT, _START = 0, 1, 2
# End of a frame that is still to come: behind everything.
OPEN = 1 << 62


def _placed(segments: DataFrame, keys: Sequence[str], seq: str, payload: str, width: int) -> DataFrame:
    """keys, offset of the segment in its connection, size, seq, bytes."""
    used = segments.select(*keys, F.col(seq).alias("_seq"), F.col(payload).alias("_bytes")).filter(F.octet_length("_bytes") > 0)
    rows = Ordered.of(used.withColumn("_size", F.octet_length("_bytes").cast("bigint")), keys, ["_seq"], width)
    rows = rows.add(_stop=rows.total(F.col("_size")))
    # Fixed once: offsets are used by every step below, and ties of the sequence have to stay as they fell.
    return fixed(rows.df.withColumn("_at", F.col("_stop") - F.col("_size")).drop("_stop"))


def _blocks(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, block, data: bytes of each block and of the longest frame behind it."""
    reach = lambda at: F.call_function("div", F.greatest(at, F.lit(0)), F.lit(BLOCK).cast("bigint"))
    last = F.col("_at") + F.col("_size")
    parts = placed.withColumn("_block", F.explode(F.sequence(reach(F.col("_at") - LONGEST), reach(last - 1))))
    low = F.greatest(F.col("_at"), F.col("_block") * BLOCK)
    high = F.least(last, (F.col("_block") + 1) * BLOCK + LONGEST)
    text = F.decode(F.substring("_bytes", (low - F.col("_at") + 1).cast("int"), (high - low).cast("int")), "ISO-8859-1")
    return (
        parts.filter(high > low).groupBy(*keys, "_block")
        .agg(F.sort_array(F.collect_list(F.struct(low.alias("low"), text.alias("text")))).alias("_parts"))
        .select(*keys, "_block", F.encode(F.array_join("_parts.text", ""), "ISO-8859-1").alias("_data"))
    )


def _heads(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, start, end of every place where a frame could begin; one that is not whole has no end."""
    have = F.octet_length("_data")
    # Places are looked for in short pieces, each with the rest of a head behind it: the work
    # on a place goes with the length of the text it is looked up in.
    piece = lambda i: F.decode(F.substring("_data", i * PIECE + 1, F.lit(PIECE + 5)), "ISO-8859-1")
    number = F.sequence(F.lit(0), F.call_function("div", F.least(have, F.lit(BLOCK)) - 1, F.lit(PIECE)).cast("int"))
    pieces = blocks.select(*keys, "_block", have.alias("_have"), F.posexplode(F.transform(number, piece)).alias("_piece", "_text"))
    cuts = F.split("_text", _HEAD, -1)
    grow = lambda done, part: F.concat(done, F.array(F.element_at(done, -1) + F.length(part)))
    starts = F.aggregate(cuts, F.array(F.lit(0)), grow)
    found = F.filter(starts, lambda p: (p < PIECE) & F.substring(F.col("_text"), p + 1, F.lit(6)).rlike(r"^##(?:\+[0-9]{3}|[0-9]{4})$"))
    rows = pieces.filter(F.col("_text").contains("##")).select(*keys, "_block", "_have", F.explode(
        F.transform(found, lambda p: F.struct(
            (F.col("_piece") * PIECE + p).alias("p"), F.substring(F.col("_text"), p + 3, F.lit(4)).cast("int").alias("n")))
    ).alias("h")).filter("h.n > 0")
    start, size = F.col("_block") * BLOCK + F.col("h.p"), F.col("h.n") + 12
    return rows.select(
        *keys, start.alias("_start"), F.when(F.col("h.p") + size <= F.col("_have"), start + size).otherwise(F.lit(OPEN)).alias("_end")
    )


def _waiting(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, place: where the last bytes of a connection may begin a frame whose head has not come."""
    have = F.octet_length("_data")
    tail = F.greatest(have - 5, F.lit(0))
    ends = blocks.select(*keys, F.struct(
        (F.col("_block") * BLOCK + have).alias("reach"), (-F.col("_block")).alias("first"),
        (F.col("_block") * BLOCK + tail).alias("from"), F.decode(F.substring("_data", tail + 1, F.lit(5)), "ISO-8859-1").alias("text"),
    ).alias("t")).groupBy(*keys).agg(F.max("t").alias("t"))
    spots = F.filter(F.sequence(F.lit(0), F.lit(4)), lambda i: (F.substring(F.col("t.text"), i + 1, F.lit(2)) == "##") | (
        (i + 1 == F.length("t.text")) & (F.substring(F.col("t.text"), i + 1, F.lit(1)) == "#")))
    return ends.select(*keys, F.explode(spots).alias("i"), "t.from").select(*keys, (F.col("from") + F.col("i")).alias("_place"))


def cut_segments(
    segments: DataFrame,
    keys: Sequence[str] = ("conn",),
    seq: str = "seq",
    payload: str = "bytes",
    width: int = 1024,
) -> DataFrame:
    """Frames (``reason`` null) and skipped bytes (with a reason) of a connection's segments.

    A frame is numbered within the segment that completed it, skipped bytes within the
    segment they came in. Bytes before ``##`` and after an unusable head are skipped; an
    unfinished frame, and a head of which less than six bytes came, wait for more.

    No task scans a connection. Segments get their offset by running sums over slices of
    ``width`` sequence numbers; the bytes are dealt out in blocks, each with the length of
    the longest frame behind it, in which every usable head is a candidate (start, end).
    Which candidates are frames is a choice of intervals that do not overlap
    (``first_disjoint``), and one ordered pass over starts, ends and segments tells where
    frames were completed and which bytes lie outside.
    """
    keys = list(keys)
    types = dict(segments.dtypes)
    placed = _placed(segments, keys, seq, payload, width)
    blocks = fixed(_blocks(placed, keys))
    heads = _heads(blocks, keys)
    taken = first_disjoint(heads, keys, ["_start"], ["_end"], touching=True, width=BLOCK * 64)
    frames = taken.withColumn("_block", F.call_function("div", F.col("_start"), F.lit(BLOCK).cast("bigint")))
    mark = lambda df, place, kind, inside, **own: df.select(
        *keys, place.alias("_pos"), F.lit(kind).alias("_kind"), inside.alias("_in"), *[c.alias(n) for n, c in own.items()]
    )
    segment = F.struct(F.col("_at").alias("at"), F.col("_seq").alias("seq"))
    line = (
        mark(placed, F.col("_at"), _SEGMENT, F.lit(None).cast("boolean"), _segment=segment)
        .unionByName(mark(frames, F.col("_start"), _START, F.lit(True)), allowMissingColumns=True)
        .unionByName(mark(frames.filter(F.col("_end") < OPEN), F.col("_end"), _END, F.lit(False), _start=F.col("_start"), _block=F.col("_block")), allowMissingColumns=True)
        .unionByName(mark(_waiting(blocks, keys), F.col("_place"), _START, F.lit(True)), allowMissingColumns=True)
        .unionByName(mark(placed, F.col("_at") + F.col("_size"), _SEGMENT, F.lit(None).cast("boolean")), allowMissingColumns=True)
    )
    rows = Ordered.of(line, keys, ["_pos", "_kind"], BLOCK * 64)
    rows = rows.add(
        _here=rows.newest(F.col("_segment")), _inside=rows.newest(F.col("_in")), _to=rows.following(F.col("_pos"))
    ).df
    number = lambda by: (F.row_number().over(Window.partitionBy(*keys, "_here").orderBy(by)) - 1).cast("int")
    whole = rows.filter(F.col("_kind") == _END).withColumn("frame_no", number("_start")).select(
        *keys, "_block", F.struct("_here.seq", "frame_no", "_start", "_pos").alias("f")
    )
    spans = whole.groupBy(*keys, "_block").agg(F.collect_list("f").alias("_frames"))
    cut = join_on(blocks, spans, [*keys, "_block"]).select(*keys, "_data", "_block", F.explode("_frames").alias("f"))
    first = (F.col("f._start") - F.col("_block") * BLOCK + 1).cast("int")
    made = cut.select(
        *keys, F.col("f.seq").alias(seq), F.col("f.frame_no").alias("frame_no"),
        F.substring("_data", first, (F.col("f._pos") - F.col("f._start")).cast("int")).alias("bytes"),
        F.lit(None).cast("string").alias("reason"),
    )
    outside = rows.filter((F.col("_to") > F.col("_pos")) & ~F.coalesce("_inside", F.lit(False)) & F.col("_here").isNotNull())
    outside = outside.withColumn("frame_no", number("_pos")).select(*keys, F.col("_here.at").alias("_at"), "frame_no", "_pos", "_to")
    noise = join_on(placed, outside, [*keys, "_at"]).select(
        *keys, F.col("_seq").cast(types[seq]).alias(seq), "frame_no",
        F.substring("_bytes", (F.col("_pos") - F.col("_at") + 1).cast("int"), (F.col("_to") - F.col("_pos")).cast("int")).alias("bytes"),
        F.lit(NOISE).alias("reason"),
    )
    return made.unionByName(noise)


def split_frames(
    segments: DataFrame,
    keys: Sequence[str] = ("conn",),
    seq: str = "seq",
    payload: str = "bytes",
    width: int = 1024,
) -> DataFrame:
    """Whole frames from a connection's byte segments, in order of ``seq``; see ``cut_segments``."""
    return cut_segments(segments, keys, seq, payload, width).filter("reason is null").drop("reason")


def skipped_bytes(
    segments: DataFrame,
    keys: Sequence[str] = ("conn",),
    seq: str = "seq",
    payload: str = "bytes",
    width: int = 1024,
) -> DataFrame:
    """What ``split_frames`` leaves out: the bytes outside frames, with a reason."""
    return cut_segments(segments, keys, seq, payload, width).filter("reason is not null")


def _utf8(latin: Column) -> Column:
    return F.encode(latin, "ISO-8859-1").cast("string")


def data_time_ns(text: Column, zone: str) -> Column:
    """14 digits in the stated zone to nanoseconds; null when malformed."""
    part = lambda a, n: F.substring(text, a, n).try_cast("int")
    stamp = F.try_make_timestamp(
        part(1, 4), part(5, 2), part(7, 2), part(9, 2), part(11, 2), part(13, 2).cast("decimal(8,6)"), F.lit(zone)
    )
    return F.when(text.rlike(r"^\d{14}$"), F.unix_micros(stamp) * 1000)


def hj212_frames(
    raw: DataFrame, payload: str = "bytes", zone: str = "UTC"
) -> tuple[DataFrame, DataFrame]:
    """(frames, rejects): checked frames with header fields, and others with a reason.

    Text is handled as one character per byte, so lengths count bytes. The CRC is
    the only part that leaves the JVM, in Arrow batches.
    """
    frame = F.regexp_replace(F.decode(F.col(payload), "ISO-8859-1"), "\r\n\\z", "")
    own = raw.columns
    s = F.col("_s")
    length = F.when(F.substring(s, 3, 4).rlike(r"^[+-]?\d+\z"), F.substring(s, 3, 4).try_cast("int"))
    step1 = compute_once(compute_once(raw, {"_s": frame}), {"_len": length})
    fits = F.coalesce(F.length(s) == F.col("_len") + 10, F.lit(False))
    step2 = compute_once(step1, {"_seg": F.when(fits, F.expr("substring(_s, 7, _len)"))})
    seg = F.col("_seg")
    step3 = step2.withColumn(
        "_crc", F.when(seg.isNotNull(), crc16(F.encode(F.coalesce(seg, F.lit("")), "ISO-8859-1")))
    )
    stated = F.expr("substring(_s, 7 + _len, 4)")
    stated_crc = F.when(stated.rlike(r"^[0-9A-Fa-f]{4}\z"), F.conv(stated, 16, 10).cast("bigint"))
    cp = F.instr(seg, "CP=&&")
    end = F.length(seg) - F.instr(F.reverse(seg), "&&")  # 1-based position of the last "&&"
    reason = (
        F.when(~s.startswith("##") | (F.length(s) < 12), "does not begin as a frame")
        .when(F.col("_len").isNull(), "length field is no number")
        .when(~fits, "length field and size differ")
        .when(stated_crc.isNull(), "checksum is no hexadecimal number")
        .when(stated_crc != F.col("_crc"), "checksum differs")
        .when(cp == 0, "no data part")
        .when((F.instr(F.reverse(seg), "&&") == 0) | (end < cp + 5), "data part is not closed")
    )
    step4 = step3.withColumn("reason", F.when(F.col(payload).isNull(), "does not begin as a frame").otherwise(reason))
    pairs = F.filter(F.split(F.expr("substring(_seg, 1, instr(_seg, 'CP=&&') - 1)"), ";"), lambda x: x.contains("="))
    header = F.map_from_entries(
        F.transform(
            pairs,
            lambda x: F.struct(
                F.substring_index(x, "=", 1).alias("k"), F.regexp_replace(x, "(?s)^[^=]*=", "").alias("v")
            ),
        )
    )
    body = F.expr(
        "substring(_seg, instr(_seg, 'CP=&&') + 5,"
        " length(_seg) - instr(reverse(_seg), '&&') - instr(_seg, 'CP=&&') - 5)"
    )
    items = F.filter(F.split(body, ";"), lambda x: x != "")
    times = F.filter(
        F.transform(
            F.filter("_items", lambda x: x.startswith("DataTime=")),
            lambda x: data_time_ns(F.regexp_replace(x, "^DataTime=", ""), zone),
        ),
        lambda t: t.isNotNull(),
    )
    field = lambda k: F.coalesce(_utf8(F.try_element_at(F.col("_h"), F.lit(k))), F.lit(""))
    good = (
        compute_once(step4.filter(F.col("reason").isNull()), {"_h": header, "_items": items})
        .select(
            *[c for c in own if c != payload],
            *[field(k).alias(k.lower()) for k in ("QN", "ST", "CN", "PW", "MN", "Flag")],
            F.coalesce(F.try_element_at(times, F.lit(-1)), F.lit(0)).cast("bigint").alias("ts_ns"),
            F.transform(F.filter("_items", lambda x: ~x.startswith("DataTime=")), _utf8).alias("items"),
        )
    )
    number = F.when(F.col("flag").rlike(r"^[+-]?\d+$"), F.col("flag").try_cast("bigint"))
    good = good.withColumn(
        "needs_ack", F.coalesce(number.bitwiseAND(F.lit(1).cast("bigint")) != 0, F.lit(False))
    )
    return good, step4.filter(F.col("reason").isNotNull()).select(*own, "reason")


def _factors(items: Column) -> Column:
    """Array of (name, number) of the numeric factors of a frame."""
    parts = F.flatten(F.transform(items, lambda i: F.split(i, ",")))

    def one(p: Column) -> Column:
        return let(F.substring_index(p, "=", 1), lambda code: named(p, code))

    def named(p: Column, code: Column) -> Column:
        suffix = F.when(code.contains("-"), F.regexp_replace(code, "(?s)^[^-]*-", ""))
        name = F.substring_index(code, "-", 1)
        label = (
            F.when(suffix == "Rtd", name)
            .when(suffix == "ZsRtd", F.concat(name, F.lit("-Zs")))
            .otherwise(F.concat(name, F.lit("-"), suffix))
        )
        number = X.parse_double(F.regexp_replace(p, "(?s)^[^=]*=", ""))
        used = p.contains("=") & suffix.isin(*VALUE_SUFFIXES)
        return F.struct(F.when(used, label).alias("name"), F.when(used, number).alias("num"))

    return F.filter(F.transform(parts, one), lambda f: f["name"].isNotNull() & f["num"].isNotNull())


def _unsendable(factors: Column) -> Column:
    infinite = F.lit(float("inf"))
    return F.exists(factors, lambda f: F.isnan(f["num"]) | (F.abs(f["num"]) == infinite))


def hj212_points(
    frames: DataFrame, keep: Sequence[str] = ("conn", "seq", "frame_no"), zone: str = "UTC"
) -> DataFrame:
    """Numeric factors of checked frames as points.

    Real-time values keep the bare factor code. A frame with a NaN or infinite
    factor yields no points at all; ``hj212_quarantine`` lists such frames. ``zone``
    is the one the frames were read with; ``dataTime`` shows their own clock.
    """
    local = F.from_utc_timestamp(F.timestamp_micros(F.expr("ts_ns div 1000")), zone)
    usable = compute_once(frames, {"_f": _factors(F.col("items"))}).filter(~_unsendable(F.col("_f")))
    return usable.select(
        *keep, "mn", "st", "cn", "ts_ns", F.posexplode("_f").alias("pos", "_p")
    ).select(
        *keep,
        "pos",
        "_p.name",
        V.num(F.col("_p.num")).alias("value"),
        "ts_ns",
        F.lit(None).cast("string").alias("error"),
        F.map_filter(
            F.create_map(
                F.lit("mn"), F.col("mn"), F.lit("st"), F.col("st"), F.lit("cn"), F.col("cn"),
                F.lit("dataTime"),
                F.when(F.col("ts_ns") != 0, F.date_format(local, "yyyy-MM-dd HH:mm:ss")),
            ),
            lambda _, v: v.isNotNull(),
        ).alias("metadata"),
    )


def hj212_quarantine(frames: DataFrame) -> DataFrame:
    return frames.filter(_unsendable(_factors(F.col("items"))))


def frame_rollup(frames: DataFrame, device: str = "mn") -> DataFrame:
    """Frames per device and data grain."""
    grain = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in GRAINS.items() for x in kv]), F.col("cn")),
        F.lit("other"),
    )
    return frames.groupBy(device, grain.alias("grain")).agg(F.count(F.lit(1)).alias("frames"))
