"""When to stop an epoch loop."""

from __future__ import annotations


class Patience:
    """Counts epochs without an improvement of at least ``min_delta``."""

    def __init__(self, patience: int | None, min_delta: float):
        self.patience, self.min_delta = patience, min_delta
        self.best, self.best_epoch, self.waited = float("inf"), None, 0

    def stops(self, value: float, epoch: int) -> bool:
        """Take an epoch's value; true when it is time to stop. Without patience never."""
        if value < self.best - self.min_delta:
            self.best, self.best_epoch, self.waited = value, epoch, 0
        else:
            self.waited += 1
        return self.patience is not None and self.waited >= self.patience
