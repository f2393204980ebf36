from .bagging import BaggingClassifier, BaggingModel
from .boosting import BoostingClassifier, BoostingModel
from .gbm import GradientBoostingClassifier, GradientBoostingModel
from .stacking import StackingClassifier, StackingModel

__all__ = ["BaggingClassifier", "BaggingModel", "BoostingClassifier", "BoostingModel",
           "GradientBoostingClassifier", "GradientBoostingModel", "StackingClassifier",
           "StackingModel"]
