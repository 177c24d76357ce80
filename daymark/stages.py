"""What the package's own pipeline stages share: Params by name, written and read with the stage."""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable

text, number, whole, flag, names = (TypeConverters.toString, TypeConverters.toFloat, TypeConverters.toInt,
                                    TypeConverters.toBoolean, TypeConverters.toListString)


def param(name: str, doc: str, kind=TypeConverters.identity) -> Param:
    return Param(Params._dummy(), name, doc, kind)


class StoredStage(DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose whole state is in its Params, so that ``write().save`` and ``load`` keep all of it."""

    def value(self, name: str):
        return self.getOrDefault(self.getParam(name))
