"""Output names by model, dimension, type, counts, k and metric.

Fixed values: the patterns of the file names, which other tools look for. They have no metric; one
other than the usual squared L2 is added to them.
"""

from __future__ import annotations

from dataclasses import dataclass

from exactnn.functions.text import DEFAULT_MODEL


def path_prefix(model: str | None) -> str:
    return model.replace("/", "_") if model else DEFAULT_MODEL


@dataclass(frozen=True)
class Naming:
    """All paths of one ground truth."""

    root: str
    model: str
    dim: int
    query_count: int
    base_count: int
    k: int
    dtype: str | None = None
    metric: str = "sqeuclidean"

    @property
    def home(self) -> str:
        sizes = f"q{self.query_count}_b{self.base_count}_k{self.k}"
        return f"{self.root}/{path_prefix(self.model)}/{sizes}"

    def _stem(self) -> str:
        parts = [path_prefix(self.model), str(self.dim)] + ([self.dtype] if self.dtype else [])
        return f"{self.home}/{'_'.join(parts)}"

    @property
    def query_table(self) -> str:
        return f"{self._stem()}_query_vector_data_{self.query_count}.parquet"

    @property
    def base_table(self) -> str:
        return f"{self._stem()}_base_vector_data_{self.base_count}.parquet"

    @property
    def result_table(self) -> str:
        """Long neighbour table."""
        return f"{self._stem()}_neighbours_{self._sizes()}.parquet"

    @property
    def query_vectors(self) -> str:
        return f"{self._stem()}_query_vectors_{self.query_count}.fvec"

    @property
    def base_vectors(self) -> str:
        return f"{self._stem()}_base_vectors_{self.base_count}.fvec"

    def _sizes(self) -> str:
        return f"b{self.base_count}_q{self.query_count}_k{self.k}{self._metric()}"

    def _metric(self) -> str:
        return "" if self.metric == "sqeuclidean" else f"_{self.metric}"

    @property
    def indices(self) -> str:
        return f"{self._stem()}_indices_{self._sizes()}.ivec"

    @property
    def distances(self) -> str:
        return f"{self._stem()}_distances_{self._sizes()}.fvec"

    @property
    def bundle(self) -> str:
        return f"{self._stem()}_base_{self.base_count}_query_{self.query_count}_k{self.k}{self._metric()}.bundle"

    def partial(self, kind: str, block: int | None = None) -> str:
        """Block files of an older run (``kind`` is indices or distances); None is the final."""
        name = f"final_{kind}" if block is None else f"{kind}{block}"
        return f"{self.home}/partial/{name}.parquet"
