"""Exploration: how near an event's topics are to what its editor did before, the recent past weighing more.

An editor's portfolio is the sum of the topic vectors of earlier events, halved with every
half-life that passed.  The cosine does not change when a portfolio is scaled, so the decay
can be counted from any moment: inside a stretch of time from its start, as plain running
sums; from stretch to stretch as a state of few numbers that is carried on and scaled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspark.session import ensure_importable

#: Half-lives in a stretch at most: weights inside it then stay finite with room.
MOST_HALF_LIVES = 400


def carried_states(zones: list[int], totals: np.ndarray, half_lives: float) -> list[tuple[list[float], float]]:
    """State before each stretch: a vector of largest component 1 (or zeros), and the logarithm of its scale.

    Scale and totals refer to the stretch's start; the logarithm keeps a portfolio of any age.
    """
    out, vector, scale = [], np.zeros(totals.shape[1]), 0.0
    for i, zone in enumerate(zones):
        if i:
            add = totals[i - 1]
            most = float(np.abs(add).max())
            if most > 0:
                # both at the larger scale
                own = np.log(most)
                top = max(own, scale) if vector.any() else own
                vector = vector * np.exp(scale - top) + add * np.exp(-top)
                peak = float(np.abs(vector).max())
                scale = top + np.log(peak) if peak > 0 else 0.0
                vector = vector / peak if peak > 0 else vector
            scale -= np.log(2) * half_lives * (zone - zones[i - 1])
        out.append((vector.tolist(), float(scale) if vector.any() else 0.0))
    return out


def exploration(events: DataFrame, id_col: str, editor: str, t: str, topics: list[str], half_life: float, width: int | None = None) -> DataFrame:
    """``(id, familiarity)``: cosine of the event's topics and the editor's portfolio before it; exploration is its lack.

    ``topics`` names the columns of the topic vector, null is zero.  ``t`` is a whole number, events of
    the same time do not count.  Without an earlier event, or where either vector is
    zero, the value is null; rows without an editor or time have null as well.
    """
    spark = events.sparkSession
    ensure_importable(spark)
    width = width or max(1, int(20 * half_life))
    lives = width / half_life
    if lives > MOST_HALF_LIVES:
        raise ValueError("a stretch must not be longer than 400 half-lives")
    n = len(topics)
    v = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in topics]
    zone = F.floor(F.col(t) / width)
    weight = F.pow(F.lit(2.0), (F.col(t) - zone * width) / F.lit(float(half_life)))
    rows = events.select(F.col(id_col).alias("_id"), F.col(editor).alias("_who"), F.col(t).alias("_t"), zone.alias("_zone"), *(v[i].alias(f"v{i}") for i in range(n)), *((v[i] * weight).alias(f"w{i}") for i in range(n)))
    past = Window.partitionBy("_who", "_zone").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    known = rows.where("_who IS NOT NULL AND _t IS NOT NULL")
    inside = known.select("_id", "_who", "_zone", *(f"v{i}" for i in range(n)), *(F.coalesce(F.sum(f"w{i}").over(past), F.lit(0.0)).alias(f"s{i}") for i in range(n)))
    # one row for an editor's stretch: as many as stretches of time, however many events
    totals = known.groupBy("_who", "_zone").agg(*(F.sum(f"w{i}").alias(f"t{i}") for i in range(n)))
    kind = rows.schema["_who"].dataType.simpleString()

    def carry(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_zone")
        states = carried_states(frame._zone.tolist(), frame[[f"t{i}" for i in range(n)]].to_numpy(float), lives)
        return pd.DataFrame({"_who": frame._who, "_zone": frame._zone, "state": [s for s, _ in states], "scale": [x for _, x in states]})

    states = totals.groupBy("_who").applyInPandas(carry, f"_who {kind}, _zone bigint, state array<double>, scale double")
    both = inside.join(states, ["_who", "_zone"])
    # an old portfolio alone has any scale; beside recent events its own
    recent = sum((F.abs(f"s{i}") for i in range(n)), F.lit(0.0)) > 0
    factor = F.when(recent, F.exp(F.least("scale", F.lit(700.0)))).otherwise(F.lit(1.0))
    p = [F.col(f"s{i}") + F.col("state")[i] * factor for i in range(n)]
    named = both.select("_id", *(F.col(f"v{i}") for i in range(n)), *(p[i].alias(f"p{i}") for i in range(n)))
    most = F.greatest(*(F.abs(f"p{i}") for i in range(n)), F.lit(0.0)) if n > 1 else F.abs("p0")
    scaled = named.select("_id", *(f"v{i}" for i in range(n)), *((F.col(f"p{i}") / F.nullif(most, F.lit(0.0))).alias(f"p{i}") for i in range(n)))
    dot = sum((F.col(f"v{i}") * F.col(f"p{i}") for i in range(n)), F.lit(0.0))
    size = lambda c: F.sqrt(sum((F.col(f"{c}{i}") * F.col(f"{c}{i}") for i in range(n)), F.lit(0.0)))
    found = scaled.select("_id", (dot / F.nullif(size("v") * size("p"), F.lit(0.0))).alias("familiarity"))
    lost = rows.where("_who IS NULL OR _t IS NULL").select("_id", F.lit(None).cast("double").alias("familiarity"))
    return found.unionByName(lost).withColumnRenamed("_id", id_col)
