"""Independent Spark jobs, submitted together."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

#: Jobs that run side by side; most of the time of a small one is planning.
JOBS_AT_ONCE = 8


def side_by_side(work: dict[str, Callable[[], object]], at_once: int = JOBS_AT_ONCE) -> dict[str, object]:
    """Results of the jobs by name; the first error is raised when all have ended."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(task) for name, task in work.items()}
        return {name: task.result() for name, task in running.items()}
