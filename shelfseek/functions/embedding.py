"""Text to vector. Any callable from a text column to an ``array<double>`` column will do."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfseek.functions.text import row_numbers, tokenize
from shelfseek.functions.vectors import ROWS_PER_SLICE

# Fixed value: length of the vectors the collection holds unless told otherwise.
DEFAULT_DIMS = 1536


class Embedder(Protocol):
    dims: int

    def __call__(self, text: Column) -> Column:
        """``array<double>`` of ``dims`` numbers, NULL where the text cannot be embedded."""


def once(udf):
    """Keep Spark from repeating the call in a filter that it moves below the projection, as it may
    with calls it takes for deterministic."""
    return udf.asNondeterministic()


def bucket_vectors(buckets: pa.Array, dims: int) -> pa.Array:
    """Counts of each bucket number per row, scaled to unit length; NULL for rows without any."""
    pieces = []
    for start in range(0, len(buckets), ROWS_PER_SLICE):
        part = buckets.slice(start, ROWS_PER_SLICE)
        cells = row_numbers(part).astype(np.int64) * dims + part.flatten().to_numpy(zero_copy_only=False)
        counts = np.bincount(cells, minlength=len(part) * dims).reshape(len(part), dims)
        norms = np.sqrt((counts * counts).sum(axis=1))
        usable = norms > 0
        offsets = np.concatenate([[0], np.cumsum(usable) * dims]).astype(np.int32)
        values = (counts[usable] / norms[usable, None]).ravel()
        pieces.append(
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(~usable))
        )
    return pa.concat_arrays(pieces) if pieces else pa.array([], pa.list_(pa.float64()))


@dataclass(frozen=True)
class HashEmbedder:
    """Offline stand-in for a model: tokens hashed to ``dims`` buckets, counted, scaled to length 1.

    The bucket of a token is the first 8 hex digits of its md5, modulo ``dims``.
    """

    dims: int = DEFAULT_DIMS

    def buckets(self, text: Column) -> Column:
        def bucket(token: Column) -> Column:
            head = F.substring(F.md5(token.cast("binary")), 1, 8)
            return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(self.dims)).cast("int")

        return F.transform(tokenize(text), bucket)

    def __call__(self, text: Column) -> Column:
        dims = self.dims

        @F.arrow_udf("array<double>")
        def vectors(buckets: pa.Array) -> pa.Array:
            return bucket_vectors(buckets, dims)

        return once(vectors)(self.buckets(text))


class Refused(Exception):
    """A call that the model turned down or lost, and that may succeed later: try again. ``after`` says in how many
    seconds, if the model told."""

    def __init__(self, message: str = "", after: float | None = None):
        super().__init__(message)
        self.after = after


#: Errors of a client that pass: calls refused, connections lost, answers too late.
PASSING = (Refused, ConnectionError, TimeoutError)


@dataclass(frozen=True)
class Patience:
    """How a task calls a model: at most ``calls_per_second``, and after a passing error up to ``attempts`` times in all,
    waiting about ``first_wait`` seconds, then twice as long each time up to ``longest_wait``, less a random part."""

    calls_per_second: float = 10.0
    attempts: int = 6
    first_wait: float = 0.5
    longest_wait: float = 30.0

    def waits(self, rng: random.Random) -> Iterator[float]:
        for k in range(self.attempts - 1):
            yield min(self.longest_wait, self.first_wait * 2**k) * (0.5 + rng.random() / 2)


class Caller:
    """One task's calls of a model, spaced out and tried again after passing errors.

    Errors not named as passing are errors of the texts: those that fail together are called for in halves, and a text
    that fails alone has no vector. Passing errors that do not pass end the task, so that no record is taken for a bad
    one because the model was not there.
    """

    def __init__(
        self,
        client: Callable[[list[str]], list[list[float]]],
        patience: Patience,
        passing: tuple[type[Exception], ...] = PASSING,
        seed: int = 0,
    ):
        self.client, self.patience, self.passing, self.rng = client, patience, passing, random.Random(seed)
        self.free_at = 0.0

    def spaced(self, texts: list[str]) -> list[list[float]]:
        wait = self.free_at - time.monotonic()
        if wait > 0:
            time.sleep(wait)
        self.free_at = max(time.monotonic(), self.free_at) + 1 / self.patience.calls_per_second
        return self.client(texts)

    def patient(self, texts: list[str]) -> list[list[float]]:
        for wait in self.patience.waits(self.rng):
            try:
                return self.spaced(texts)
            except self.passing as error:
                time.sleep(max(wait, getattr(error, "after", None) or 0))
        return self.spaced(texts)

    def vectors(self, texts: list[str]) -> list[list[float] | None]:
        try:
            found = self.patient(texts)
            if len(found) != len(texts):
                raise ValueError("the model returned another number of vectors")
            return [[float(x) for x in v] for v in found]
        except self.passing:
            raise
        except Exception:
            if len(texts) == 1:
                return [None]
            # Halves, not single texts: one bad text among many costs few calls.
            half = len(texts) // 2
            return self.vectors(texts[:half]) + self.vectors(texts[half:])


@dataclass(frozen=True)
class ModelEmbedder:
    """A model behind a batch call. ``make_client`` runs once per task and returns a function from a list of texts to
    as many vectors. ``passing`` names the client's errors that are worth another try; see ``Caller`` for all others."""

    make_client: Callable[[], Callable[[list[str]], list[list[float]]]]
    dims: int = DEFAULT_DIMS
    texts_per_call: int = 64
    patience: Patience = Patience()
    passing: tuple[type[Exception], ...] = PASSING

    def __call__(self, text: Column) -> Column:
        make_client, size, patience, passing = self.make_client, self.texts_per_call, self.patience, self.passing

        @F.arrow_udf("array<double>")
        def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            context = TaskContext.get()
            caller = Caller(make_client(), patience, passing, context.partitionId() if context else 0)
            for batch in batches:
                texts = batch.to_pylist()
                present = [i for i, t in enumerate(texts) if t is not None]
                out: list[list[float] | None] = [None] * len(texts)
                for start in range(0, len(present), size):
                    chosen = present[start : start + size]
                    for i, vector in zip(chosen, caller.vectors([texts[i] for i in chosen]), strict=True):
                        out[i] = vector
                yield pa.array(out, pa.list_(pa.float64()))

        return once(vectors)(text)
