"""Fitted models that are kept, and used again without a fit.

    models/fitted/<forest>/t_end=…/<rows>    one model, as the library writes it
    models/index/part=…                      which window's rows each was fitted on

A model belongs to the rows of its train part, by their number and checksum, and to everything that its fit depends
on: parameters, features, label and layout. It enters the index after it is whole, so what the index names can be loaded.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce
from itertools import zip_longest

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.latest import read_parts, read_replacing
from tidegauge.schemas import MODEL_INDEX
from tidegauge.sinks import write_part
from tidegauge.sinks.tables import PART

_KEY = ("forest", "t_end")


def assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip").transform(df)


def fingerprint(estimator: Estimator, features: Sequence[str], label: str, layout: int) -> str:
    """Names everything that a fit depends on besides its rows."""
    parameters = {p.name: repr(v) for p, v in estimator.extractParamMap().items()}
    text = json.dumps([type(estimator).__name__, parameters, list(features), label, layout], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


class ModelStore:
    """The models of one folder that have one fingerprint."""

    def __init__(self, spark: SparkSession, path: str, forest: str):
        self.spark, self.path, self.forest = spark, path.rstrip("/"), forest

    def index(self) -> DataFrame:
        """``t_end``, ``n_train``, ``train_sum`` and ``model``: the path of the window's last fit."""
        stored = read_replacing(self.spark, f"{self.path}/index", MODEL_INDEX, _KEY)
        return stored.filter(F.col("forest") == self.forest).drop("forest")

    def save(self, model: Model, window: Row) -> str:
        """The path that the model was written to; ``window`` has ``t_end``, ``n_train`` and ``train_sum``."""
        rows = f"{window['n_train']}-{window['train_sum'] & (1 << 64) - 1:016x}"
        path = f"{self.path}/fitted/{self.forest}/t_end={window['t_end']}/{rows}"
        model.write().overwrite().save(path)
        return path

    def add(self, fitted: Sequence[tuple[Row, str]]) -> None:
        """Put models that are whole into the index."""
        if not fitted:
            return
        rows = [(w["t_end"], w["n_train"], w["train_sum"], self.forest, path) for w, path in fitted]
        last = read_parts(self.spark, f"{self.path}/index", MODEL_INDEX).agg(F.max(PART)).first()[0]
        write_part(self.spark.createDataFrame(rows, MODEL_INDEX).coalesce(1), f"{self.path}/index", 0 if last is None else last + 1, ["t_end"])

    def load(self, path: str) -> Model:
        return DefaultParamsReader.loadParamsInstance(path, self.spark)

    def newest(self, before: int | None = None) -> tuple[int, Model] | None:
        """``t_end`` and model of the last window that ends by the time ``before``, or of the last of all; None without one."""
        known = self.index() if before is None else self.index().filter(F.col("t_end") <= before)
        last = known.agg(F.max(F.struct("t_end", "model")).alias("last")).first()["last"]
        return None if last is None else (last["t_end"], self.load(last["model"]))

    def scored(self, rows: DataFrame, features: Sequence[str], time: str = "t") -> DataFrame:
        """Each row with the ``prediction`` of the newest model whose window ends by its time, and that window's ``t_end``.

        ``rows`` is a stored table: models are loaded for the stretch of time that it covers, and each reads its own part of
        that. Rows before the first model, or with a missing feature or time, are left out. Nothing is fitted.
        """
        low, high = rows.agg(F.min(time), F.max(time)).first()
        known = [] if low is None else self.index().filter(F.col("t_end") <= high).orderBy("t_end").collect()
        parts = []
        for window, end in zip_longest(known, [r["t_end"] for r in known[1:]]):
            if end is None or end > low:
                own = rows.filter(F.col(time) >= window["t_end"])
                own = own if end is None else own.filter(F.col(time) < end)
                parts.append(predicted(self.load(window["model"]), own, features).withColumn("t_end", F.lit(window["t_end"]).cast("bigint")))
        empty = rows.limit(0).withColumns({"prediction": F.lit(0.0), "t_end": F.lit(0).cast("bigint")})
        return reduce(DataFrame.unionByName, parts, empty)


def predicted(model: Model, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """The rows, of a table or a stream, with their ``prediction``; those with a missing feature are left out."""
    return model.transform(assembled(rows, features)).select(*rows.columns, "prediction")
