from .comparison import Comparison, prefix
from .passengers import PassengerPrep, PassengerPrepModel
from .players import player_frame, player_schema
from .tuning import (best_point, cross_validate, cross_validated_score, cv_results, fit_predict,
                     leaderboard, param_grid)

__all__ = ["Comparison", "prefix", "PassengerPrep", "PassengerPrepModel", "player_frame", "player_schema", "best_point",
           "cross_validate", "cross_validated_score", "cv_results", "fit_predict", "leaderboard",
           "param_grid"]
