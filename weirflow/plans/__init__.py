from weirflow.plans.oracles import ORACLES
from weirflow.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
