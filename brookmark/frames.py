"""Named frames that are built when they are asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyFrames(Mapping[str, DataFrame]):
    """Mapping of names to frames; composing a plan costs driver time, so unused ones are not."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def replaced(self, **made: DataFrame) -> LazyFrames:
        """The same frames with some given outright."""
        return self.joined({name: (lambda df=df: df) for name, df in made.items()})

    def joined(self, makers: Mapping[str, Callable[[], DataFrame]]) -> LazyFrames:
        """These frames and more; later names win."""
        own = {name: (lambda name=name: self[name]) for name in self._makers}
        return LazyFrames({**own, **makers})

    def without(self, prefix: str) -> LazyFrames:
        kept = [n for n in self._makers if not n.startswith(prefix)]
        return LazyFrames({name: (lambda name=name: self[name]) for name in kept})
