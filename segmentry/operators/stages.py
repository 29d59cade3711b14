"""Preprocessing and K-means as ``pyspark.ml`` stages, so that one saved ``PipelineModel`` places new customers.

The stages hold parameters only and hand the work to ``Preprocessor`` and ``kmeans``; what is learnt is written next to
the stage's metadata, in shared storage.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.operators.kmeans import KMeansFit, assign, kmeans
from segmentry.operators.preprocess import Preprocessor, PreprocessModel


class _Writer(MLWriter):
    """Metadata of the parameters, and what the stage has learnt in ``learnt``."""

    def __init__(self, stage: _Stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        if self.stage.learnt is not None:
            self.stage.learnt.save(self.sparkSession, f"{path}/learnt")


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        stage = self.kind()
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        if stage.learns is not None:
            stage.learnt = stage.learns.load(self.sparkSession, f"{path}/learnt")
        return stage


class _Stage(MLReadable, MLWritable):
    learns: type | None = None
    learnt = None

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _PreprocessParams(Params):
    key = Param(Params._dummy(), "key", "column that names a row", TypeConverters.toString)
    scalingMethod = Param(Params._dummy(), "scalingMethod", "robust or standard", TypeConverters.toString)
    missingValues = Param(Params._dummy(), "missingValues", "median, mean, mode or drop", TypeConverters.toString)
    correlationThreshold = Param(Params._dummy(), "correlationThreshold", "columns above it go", TypeConverters.toFloat)
    varianceThreshold = Param(Params._dummy(), "varianceThreshold", "columns below it go", TypeConverters.toFloat)
    pcaVariance = Param(Params._dummy(), "pcaVariance", "share that principal components explain; 0 for none", TypeConverters.toFloat)

    def __init__(self, **given):
        super().__init__()
        self._setDefault(
            key="user_id", scalingMethod="robust", missingValues="median", correlationThreshold=settings.CORRELATION_THRESHOLD,
            varianceThreshold=settings.VARIANCE_THRESHOLD, pcaVariance=0.0,
        )
        self._set(**given)


class FeaturePreprocessor(_PreprocessParams, Estimator, _Stage):
    """Learns from a frame of a key and numeric features; see ``Preprocessor``."""

    def _fit(self, dataset: DataFrame) -> FeaturePreprocessorModel:
        share = self.getOrDefault("pcaVariance")
        learnt = Preprocessor(
            scaling_method=self.getOrDefault("scalingMethod"),
            correlation_threshold=self.getOrDefault("correlationThreshold"),
            variance_threshold=self.getOrDefault("varianceThreshold"),
            use_pca=share > 0,
            pca_variance_explained=share or settings.PCA_VARIANCE,
            missing_value_strategy=self.getOrDefault("missingValues"),
            key=self.getOrDefault("key"),
        ).fit(dataset)
        model = self._copyValues(FeaturePreprocessorModel())
        model.learnt = learnt
        return model


class FeaturePreprocessorModel(_PreprocessParams, Model, _Stage):
    """Turns features into ``(id, features array<double>)``."""

    learns = PreprocessModel

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.learnt.vectors(dataset)


class _SegmentParams(Params):
    k = Param(Params._dummy(), "k", "number of segments", TypeConverters.toInt)
    starts = Param(Params._dummy(), "starts", "k-means++ starts, of which the cheapest stays", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the starts", TypeConverters.toInt)
    predictionCol = Param(Params._dummy(), "predictionCol", "column of the segment", TypeConverters.toString)

    def __init__(self, **given):
        super().__init__()
        self._setDefault(k=settings.DEFAULT_K, starts=settings.N_INIT, seed=settings.SEED, predictionCol="cluster")
        self._set(**given)


class CustomerSegments(_SegmentParams, Estimator, _Stage):
    """K-means over ``(id, features)``."""

    def _fit(self, dataset: DataFrame) -> CustomerSegmentsModel:
        model = self._copyValues(CustomerSegmentsModel())
        model.learnt = kmeans(dataset, self.getOrDefault("k"), self.getOrDefault("starts"), self.getOrDefault("seed"))
        return model


class CustomerSegmentsModel(_SegmentParams, Model, _Stage):
    learns = KMeansFit

    @property
    def centers(self) -> np.ndarray:
        return self.learnt.centers

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.getOrDefault("predictionCol")
        return assign(dataset.select("id", "features"), {out: self.learnt.centers}).withColumn(out, F.col(out).cast("int"))
