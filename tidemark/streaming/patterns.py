"""Stream forms of the sequence, deadline, cap and reconciliation operators.

The batch functions in ``operators`` call these when they are given a stream.  The
stream needs a watermark (``operators.with_event_time``) and gives append-mode rows, each
once the watermark has decided it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import from_epoch_us, to_us
from tidemark.streaming import machines
from tidemark.streaming.replay import replay

def packed(df, columns):
    """The columns as one struct, its times in microseconds, so that they keep every digit."""
    kinds = {c: df.schema[c].dataType.typeName() for c in columns}
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias(c)
    return F.struct(*[micros(c) if kinds[c] in TIMES else F.col(c) for c in columns])


def unpacked(df, columns, struct):
    """The columns of a packed struct."""
    return [
        (from_epoch_us(F.col(f"{struct}.`{c}`"), df.schema[c].dataType) if df.schema[c].dataType.typeName() in TIMES else F.col(f"{struct}.`{c}`")).alias(c)
        for c in columns
    ]


TIMES = ("timestamp", "timestamp_ntz")


def _flag(condition, value):
    return F.when(condition, value).otherwise(0)


def strict_sequence(df, keys, first, then, within, ts, seq):
    tag = _flag(first, 1) + _flag(then, 2)
    found = replay(df, keys, machines.Pairs(to_us(within)), ts, seq, tag)
    return found.select(
        *keys,
        from_epoch_us(F.col("_a")).alias("first_ts"),
        from_epoch_us(F.col("_b")).alias("last_ts"),
    )


def fail_burst(df, keys, is_fail, horizon, min_count, ts, seq):
    machine = machines.Bursts(to_us(horizon), min_count)
    found = replay(df, keys, machine, ts, seq, _flag(is_fail, 1))
    return found.select(
        *keys,
        from_epoch_us(F.col("_a")).alias("first_ts"),
        from_epoch_us(F.col("_b")).alias("last_ts"),
        F.col("_n").alias("cnt"),
    )


def followed_by(df, keys, first, then, within, ts, seq):
    rows = df.where(first | then)
    tag = _flag(first, 1) + _flag(then, 2)
    found = replay(rows, keys, machines.Follows(to_us(within)), ts, seq, tag)
    return found.select(
        *keys,
        from_epoch_us(F.col("_a")).alias("first_ts"),
        from_epoch_us(F.col("_b")).alias("then_ts"),
        F.col("_kind").alias("kind"),
    )


def lifecycle_status(df, keys, first, then, deadline, wait, keep, ts, seq):
    rows = df.where(first | then)
    tag = _flag(first, 1) + _flag(then, 2)
    machine = machines.Lifecycle(to_us(deadline), to_us(wait), to_us(keep))
    found = replay(rows, keys, machine, ts, seq, tag)
    return found.select(
        *keys,
        from_epoch_us(F.col("_a")).alias("create_ts"),
        from_epoch_us(F.col("_b")).alias("pay_ts"),
        F.col("_kind").alias("status"),
    )


def click_cap(df, keys, passes, period, ts, seq):
    """The rows keep their event time, so windows can follow."""
    others = [c for c in df.columns if c not in (*keys, ts)]
    machine = machines.Cap(passes, to_us(period))
    found = replay(df, keys, machine, ts, seq, F.lit(0), packed(df, others), event_time="_ts")
    rows = dict(zip(others, unpacked(df, others, "_left"), strict=True))
    opened = found.withColumnRenamed("_ts", ts)
    return opened.select(*[rows.get(c, F.col(c)) for c in df.columns], F.col("_kind").alias("kind"))


def reconcile(left, right, key, tolerance, ts, seq):
    def side(df, tag, name, other):
        # A NULL key matches nothing: such rows of the two sides never meet.
        apart = F.when(F.col(key).isNull(), tag).alias("_apart")
        none = F.lit(None).cast(other.select(packed(other, other.columns).alias("s")).schema["s"].dataType)
        sides = {name: packed(df, df.columns), "left" if name == "right" else "right": none}
        row = F.struct(sides["left"].alias("left"), sides["right"].alias("right"))
        return df.select(key, apart, ts, seq, F.lit(tag).alias("_side"), row.alias("_row"))

    both = side(left, 0, "left", right).unionByName(side(right, 1, "right", left))
    machine = machines.Reconcile(to_us(tolerance))
    found = replay(both, [key, "_apart"], machine, ts, seq, F.col("_side"), F.col("_row"))

    def whole(df, name):
        packed = f"_{name}.{name}"
        row = F.struct(*unpacked(df, df.columns, packed))
        return F.when(F.col(packed).isNotNull(), row).alias(name)

    return found.select(key, F.col("_kind").alias("kind"), whole(left, "left"), whole(right, "right"))
