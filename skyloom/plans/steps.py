"""Named post-processing steps, run in order on one table of cubes.

The table carries ``tag``, the dataset a row belongs to; each reduction adds
its name to it, as every step gives new datasets.
"""

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.operators.grid import CELL, daily_reduce, monthly_reduce

log = logging.getLogger(__name__)

DAILY = ("mean", "median", "min", "max", "std", "sum")
MONTHLY = ("mean", "median", "min", "max", "std")

Step = Callable[..., DataFrame]


def _reduction(period: str, how: str) -> Step:
    reduce = daily_reduce if period == "daily" else monthly_reduce

    def step(df: DataFrame, by: Sequence[str] = CELL, **kwargs) -> DataFrame:
        reduced = reduce(df, how, by=["tag", *by], **kwargs)
        return reduced.withColumn("tag", F.concat("tag", F.lit(f"_{period}-{how}")))

    return step


class Steps:
    """Step names a dataset knows; users may add their own."""

    def __init__(self) -> None:
        self.known: dict[str, Step] = {f"daily_{how}": _reduction("daily", how) for how in DAILY}
        self.known |= {f"monthly_{how}": _reduction("monthly", how) for how in MONTHLY}

    def register(self, name: str, step: Step) -> None:
        self.known[name] = step

    def run(self, df: DataFrame, config: Sequence[dict]) -> DataFrame:
        """Run the named steps; a name nobody knows is passed over with a warning."""
        for entry in config:
            arguments = dict(entry)
            name = arguments.pop("method", None)
            if name not in self.known:
                log.warning("Ignoring invalid post-processor config: %s", entry)
                continue
            df = df.transform(self.known[name], **arguments)
        return df


def run_steps(df: DataFrame, config: Sequence[dict]) -> DataFrame:
    return Steps().run(df, config)
