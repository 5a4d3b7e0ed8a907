"""Linear models as settings: scored by a column expression, so a ranking needs no Python and reads only its features."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Linear:
    """score = 1 / (1 + exp(-(slope * margin + shift))), margin = intercept + sum of weight * (value - centre) / scale, a missing
    value as its fill. slope and shift are 1 and 0 unless the margin was calibrated."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float = 0.0
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    fill: tuple[float, ...] = ()
    slope: float = 1.0
    shift: float = 0.0

    def margin(self) -> Column:
        n = len(self.features)
        out = F.lit(self.intercept)
        for f, w, c, s, v in zip(self.features, self.weights, self.centre or (0.0,) * n, self.scale or (1.0,) * n, self.fill or (0.0,) * n, strict=True):
            value = F.coalesce(F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None)), F.lit(v))
            out = out + F.lit(w) * (value - F.lit(c)) / F.lit(s if s else 1.0)
        return out

    def score(self) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.slope) * self.margin() + F.lit(self.shift))))

    def predict(self, rows: DataFrame, threshold: float = 0.5) -> DataFrame:
        """rows with score and prediction."""
        if lost := [f for f in self.features if f not in rows.columns]:
            raise ValueError(f"missing features: {', '.join(lost)}")
        out = rows.withColumn("score", self.score())
        return out.withColumn("prediction", (F.col("score") >= threshold).cast("int"))

    def settings(self) -> dict:
        return {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(self).items()}

    @staticmethod
    def of(settings: dict) -> Linear:
        return Linear(**{k: tuple(v) if isinstance(v, list) else v for k, v in settings.items()})


def of_pipeline(model: PipelineModel, features: list[str]) -> Linear:
    """A fitted pipeline of imputer, assembler, robust scaler and a linear classifier as settings."""
    last = model.stages[-1]
    if not hasattr(last, "coefficients"):
        raise ValueError(f"not a linear model: {type(last).__name__}")
    imputer, _, scaler, _ = model.stages
    fill = imputer.surrogateDF.head().asDict()
    return Linear(tuple(features), tuple(map(float, last.coefficients)), float(last.intercept), tuple(map(float, scaler.median)), tuple(map(float, scaler.range)), tuple(float(fill[f]) for f in features))
