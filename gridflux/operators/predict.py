"""Ensemble inference on Arrow batches, and per-seed back-transformation."""

from __future__ import annotations

from dataclasses import dataclass
from typing import IO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gridflux.functions.power import Power
from gridflux.operators.isolation import map_isolated
from gridflux.operators.nn import Net, forward
from gridflux.operators.targets import Smear, smear_batches

BATCH = 1024  # rows whose layers stay in a core's cache


@dataclass(frozen=True)
class Member:
    """One seed of an ensemble: weights and the scalers it was trained with."""

    weights: dict
    scalers: dict[str, Power]


@dataclass(frozen=True)
class Ensemble:
    targets: tuple[str, ...]
    context: tuple[str, ...]
    side: int
    members: tuple[Member, ...]
    width: str = "B"

    def check(self) -> None:
        for m in self.members:
            if tuple(m.scalers) != self.targets:
                raise ValueError("members differ in their targets")

    def run(self, images: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        """(member, row, target) on the transformed scale, in single precision; an input
        beyond its range is an error."""
        with np.errstate(over="ignore"):
            images, ctx = images.astype(np.float32), ctx.astype(np.float32)
        if not (np.isfinite(images).all() and np.isfinite(ctx).all()):
            raise OverflowError("an input is beyond single precision")
        nets = [Net(dict(m.weights)).single() for m in self.members]
        return np.stack([forward(net, "C2D", images, len(self.targets), self.width, ctx) for net in nets]).astype(np.float64)


def read_checkpoint(file: str | IO[bytes], width: str = "B") -> Ensemble:
    """An ensemble from an ``.npz`` file or an open binary one: for each seed k arrays
    ``k/<weight>``, and ``targets``, ``context``, ``side``, and by seed and target
    ``lambda``, ``mean``, ``scale``.  Raises where a weight is missing or misshapen."""
    with np.load(file) as f:
        targets, context, side = tuple(f["targets"].tolist()), tuple(f["context"].tolist()), int(f["side"])
        members = []
        for k in range(len(f["lambda"])):
            weights = {name.partition("/")[2]: f[name] for name in f.files if name.startswith(f"{k}/")}
            scalers = {t: Power(*(float(f[p][k, i]) for p in ("lambda", "mean", "scale"))) for i, t in enumerate(targets)}
            members.append(Member(weights, scalers))
    model = Ensemble(targets, context, side, tuple(members), width)
    model.check()
    probe = Net()
    forward(probe, "C2D", np.zeros((1, 1, side, side)), len(targets), width, np.zeros((1, len(context))))
    for k, m in enumerate(members):
        wrong = sorted(n for n, shape in probe.shapes.items() if n not in m.weights or m.weights[n].shape != shape)
        if wrong:
            raise ValueError(f"seed {k} lacks weights or has them in another shape: {wrong[:5]}")
    return model


def write_checkpoint(model: Ensemble, file: str | IO[bytes]) -> None:
    parts = {f"{k}/{n}": w for k, m in enumerate(model.members) for n, w in m.weights.items()}
    for p, get in (("lambda", "lam"), ("mean", "mean"), ("scale", "scale")):
        parts[p] = np.array([[getattr(m.scalers[t], get) for t in model.targets] for m in model.members])
    np.savez(file, targets=np.array(model.targets), context=np.array(model.context), side=model.side, **parts)


def scaled_names(model: Ensemble) -> list[str]:
    return [f"{t}__{seed}" for seed in range(len(model.members)) for t in model.targets]


def _images(column: pa.Array, size: int) -> np.ndarray:
    """(rows, size) of a list column from its flat values; NaN where a row has no whole image."""
    out = np.full((len(column), size), np.nan)
    whole = np.flatnonzero(pc.equal(pc.fill_null(pc.list_value_length(column), -1), size).to_numpy(zero_copy_only=False))
    if len(whole):
        out[whole] = column.take(pa.array(whole)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)
    return out


def predict(rows: DataFrame, model: Ensemble, keep: list[str], image: str = "image", isolate: list[str] | None = None) -> DataFrame:
    """``keep`` and a column for each target and member (``scaled_names``), on the
    transformed scale; null where the image or a context value is missing.  ``image``
    is the flat image, context columns are named by the model.  The weights, some
    hundred kilobytes, are broadcast.  With ``isolate``, a key of ``keep``, rows of a key
    whose networks fail have nulls and the message in a further column ``error``."""
    model.check()
    shared = rows.sparkSession.sparkContext.broadcast(model)
    size, names, n_keep = model.side**2, scaled_names(model), len(keep)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, n = shared.value, batch.num_rows
        out = np.full((len(m.members), n, len(m.targets)), np.nan)
        for at in range(0, n, BATCH):
            part = batch.slice(at, BATCH)
            flat = _images(part.column(n_keep), size)
            ctx = np.column_stack([part.column(n_keep + 1 + k).to_numpy(zero_copy_only=False).astype(float) for k in range(len(m.context))]) if m.context else np.zeros((part.num_rows, 0))
            good = np.flatnonzero(np.isfinite(flat).all(axis=1) & np.isfinite(ctx).all(axis=1))
            if len(good):
                out[:, at + good] = m.run(flat[good].reshape(-1, 1, m.side, m.side), ctx[good])
        cols = [batch.column(k) for k in range(n_keep)]
        cols += [pa.array(out[s, :, k], pa.float64(), mask=np.isnan(out[s, :, k])) for s in range(len(m.members)) for k in range(len(m.targets))]
        return pa.RecordBatch.from_arrays(cols, names=[*keep, *names])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"`{n}` double" for n in names)])
    asked = rows.select(*keep, image, *model.context)
    if isolate:
        return map_isolated(asked, work, schema, isolate)
    return asked.mapInArrow(lambda batches: map(work, batches), schema)


def back_transform(preds: DataFrame, model: Ensemble, keep: list[str], draws: list[dict[str, list[float]]] | None = None,
                   bounds: list[dict] | None = None, limits: dict | None = None) -> DataFrame:
    """Inverse per seed (smeared by the seed's draws, inside its bounds), then the
    mean over seeds that have a value, inside the training range: one pass over Arrow
    batches."""

    def how(seed: int, t: str) -> Smear:
        d = draws[seed].get(t) if draws else None
        return Smear(model.members[seed].scalers[t], tuple(d or ()), tuple(bounds[seed][t]) if bounds else None, tuple(limits[t]) if limits else None)

    return smear_batches(preds, {t: [(f"{t}__{seed}", how(seed, t)) for seed in range(len(model.members))] for t in model.targets}, keep)
