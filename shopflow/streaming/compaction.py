"""Folding of finished batches beside a running stream."""

from __future__ import annotations

from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.util import inheritable_thread_target

from shopflow.sources.store import EVERY, ResultTable


class Compaction:
    """Calls ``table.compact`` once in ``every`` batches, in a thread of the driver, so that the batches go on.

    At most one call runs at a time; what one missed the next makes up for.  An error in it
    stops the stream at the next call, as an error in a batch would.
    """

    def __init__(self, table: ResultTable, every: int = EVERY, background: bool = True):
        self.table, self.every = table, every
        self.pool = ThreadPoolExecutor(max_workers=1) if background else None
        self.running: Future | None = None

    def after(self, batch_id: int) -> None:
        """To be called in batch ``batch_id``: the batches before it are finished for good."""
        if batch_id % self.every or not batch_id:
            return
        self.wait()
        if self.pool is None:
            self.table.compact(batch_id - 1, self.every)
        else:
            work = inheritable_thread_target(self.table.spark)(self.table.compact)
            self.running = self.pool.submit(work, batch_id - 1, self.every)

    def wait(self) -> None:
        """Until the last call has ended; its error, if any, is raised here."""
        if self.running is not None:
            self.running.result()
            self.running = None
