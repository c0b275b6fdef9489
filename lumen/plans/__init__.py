from lumen.plans.oracles import ORACLES  # noqa: F401
from lumen.plans.queries import QUERIES  # noqa: F401
