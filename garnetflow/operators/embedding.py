"""Embeddings from a service: calls within a limit over all tasks, answers validated, failures kept apart."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


class Pace:
    """Waits so that calls are at least a step apart, as one of several tasks that share a limit."""

    def __init__(self, per_second: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.step, self.clock, self.sleep, self.due = 1.0 / per_second, clock, sleep, None

    def wait(self) -> None:
        now = self.clock()
        if self.due is not None and now < self.due:
            self.sleep(self.due - now)
            now = self.due
        self.due = now + self.step


def problem(vector, size: int | None) -> str | None:
    """What is wrong with an answer, or None: it has to be `size` finite numbers, not all of them 0."""
    if vector is None or len(vector) == 0:
        return "empty"
    if size is not None and len(vector) != size:
        return f"{len(vector)} numbers"
    if not all(isinstance(x, int | float) and math.isfinite(x) for x in vector):
        return "not a number"
    return None if any(vector) else "zero"


def service(call: Callable[[str], list[float]], per_second: float, tasks: int = 4, size: int | None = None, tries: int = 3, wait: float = 1.0) -> Callable[[DataFrame], DataFrame]:
    """An embed function: rows with the columns embedding (null if it failed) and problem.

    The limit is shared: rows are dealt to `tasks` tasks, and each keeps to per_second / tasks, repeated calls included, so that all together
    stay within it. A call that raises, or whose answer is wrong, is tried again after a wait that doubles.
    """

    def embed(rows: DataFrame) -> DataFrame:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pace = Pace(per_second / tasks)
            for batch in batches:
                vectors, problems = [], []
                for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                    vector, wrong = None, "no text"
                    for k in range(tries if text else 0):
                        if k:
                            time.sleep(wait * 2 ** (k - 1))
                        pace.wait()
                        try:
                            vector = call(text)
                            wrong = problem(vector, size)
                        except Exception as e:  # a service fails in many ways: all are tried again, then noted
                            wrong = f"{type(e).__name__}: {e}"
                        if wrong is None:
                            break
                    vectors.append(vector if wrong is None else None)
                    problems.append(wrong)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vectors, pa.list_(pa.float64())), pa.array(problems, pa.string())], [*batch.schema.names, "embedding", "problem"])

        # a stage of exactly `tasks` tasks: adaptive execution leaves a stated number as it is
        return rows.repartition(tasks).mapInArrow(run, f"{schema}, embedding array<double>, problem string")

    return embed
