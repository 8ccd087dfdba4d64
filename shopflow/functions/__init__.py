from shopflow.functions.columns import *  # noqa: F401,F403
from shopflow.functions.predicates import *  # noqa: F401,F403
