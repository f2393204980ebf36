from . import combining, comparing, encoding, ensembles, exploring, learning, linear, measuring, players, preparing, scanning, sparse, trees
from .registry import CATALOG

__all__ = ["CATALOG", "combining", "comparing", "encoding", "ensembles", "exploring", "learning", "linear", "measuring",
           "players", "preparing", "scanning", "sparse", "trees"]
