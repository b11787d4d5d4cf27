"""Python workers give back what a task has freed."""

from pathlib import Path

from candlewick.llm.common import tidied

PIECES = 2000


def held_mb():
    pages = int(Path("/proc/self/statm").read_text().split()[1])
    return pages * 4096 / 1e6


def test_a_finished_task_holds_no_freed_memory():
    """Pieces below the size that is mapped on its own, with one behind them that stays."""
    pins = []

    def run(batches):
        for batch in batches:
            pieces = [bytearray(b"x") * 100_000 for _ in range(PIECES)]
            pins.append(bytearray(b"x") * 100_000)
            yield batch + len(pieces)

    before = held_mb()
    assert list(tidied(run)([1, 2])) == [PIECES + 1, PIECES + 2]
    assert held_mb() - before < 60


def test_an_abandoned_or_empty_task_gives_its_rows_alone():
    assert list(tidied(lambda batches: iter(batches))([])) == []
    found = tidied(lambda batches: (b * 2 for b in batches))([1, 2, 3])
    assert next(found) == 2
    found.close()
