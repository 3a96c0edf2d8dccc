"""A failing stream stops the streams that run beside it."""

import pytest

from tidemark.streaming.bronze import await_all


class Query:
    def __init__(self, name, error=None, done=False):
        self.name, self.error, self.isActive = name, error, not done

    def awaitTermination(self, timeout=None):
        if self.error:
            self.isActive = False
        return True

    def exception(self):
        return self.error

    def stop(self):
        self.isActive = False
        self.stopped = True


def test_siblings_are_stopped_and_the_failure_is_raised():
    queries = [Query("fails", error="boom"), Query("slow"), Query("finished", done=True)]
    with pytest.raises(RuntimeError, match="fails: boom"):
        await_all(queries)
    assert not any(q.isActive for q in queries) and queries[1].stopped and not hasattr(queries[2], "stopped")
