"""User-defined functions: scalar, aggregate, collation, table-valued (L)."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


STATES_HELD = 50_000  # states of groups that a task keeps before it passes them on


def register_scalar(spark: SparkSession, name: str, fn: Callable, returns: str, user_data=None):
    """A function over pandas Series, callable from SQL and the DataFrame API (L1).

    ``user_data`` is passed as first argument when given.
    """
    def call(*columns: pd.Series) -> pd.Series:
        return fn(*columns) if user_data is None else fn(user_data, *columns)

    udf = F.pandas_udf(call, returns)
    return spark.udf.register(name, udf)


def aggregate(
    df: DataFrame,
    groups: list[str],
    init: Callable[[], object],
    step: Callable[[object, pd.DataFrame], object],
    merge: Callable[[object, object], object],
    finish: Callable[[object], float],
    out: str,
) -> DataFrame:
    """A step/finalise aggregate in two phases (L2).

    ``step`` folds the rows of a group into a state inside each partition, so only
    one small state per group and partition is shuffled; ``merge`` combines them.
    """
    keys = ", ".join(f"{n} {t}" for n, t in df.select(*groups).dtypes)

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def packed(states: dict) -> pd.DataFrame:
            return pd.DataFrame([(*key, pickle.dumps(state)) for key, state in states.items()], columns=[*groups, "_state"])

        states: dict = {}
        for frame in frames:
            for key, part in frame.groupby(groups, sort=False, dropna=False):
                states[key] = step(states.get(key) if key in states else init(), part)
            if len(states) >= STATES_HELD:  # a group may leave a task in several states; merging them is exact
                yield packed(states)
                states = {}
        yield packed(states)

    def final(frame: pd.DataFrame) -> pd.DataFrame:
        states = [pickle.loads(s) for s in frame["_state"]]  # states written by partial above
        total = states[0]
        for s in states[1:]:
            total = merge(total, s)
        return pd.DataFrame([(*frame[groups].iloc[0], float(finish(total)))], columns=[*groups, out])

    states = df.mapInPandas(partial, f"{keys}, _state binary")
    return states.groupBy(*groups).applyInPandas(final, f"{keys}, {out} double")


def mean_squared_difference(a: Column, b: Column) -> Column:
    """The same kind of aggregate as a native expression, which is to be preferred."""
    return F.avg(F.pow(a - b, F.lit(2)))


def order_key(text: Column, collation: str = "UTF8_LCASE") -> Column:
    """Text under another order: comparison, grouping and sorting follow the collation (L3)."""
    return F.collate(text, collation)


@F.udtf(returnType="pos int, word string", useArrow=True)
class Words:
    """Table-valued: the words of a text, one row each (L4); rows travel in Arrow batches."""

    def eval(self, text: str):
        for i, word in enumerate((text or "").split(" ")):
            yield i, word


def register_table_function(spark: SparkSession, name: str, udtf) -> None:
    spark.udtf.register(name, udtf)
