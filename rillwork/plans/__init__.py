from rillwork.plans import analyses, basics, stateful, streams  # noqa: F401
from rillwork.plans.registry import REGISTRY  # noqa: F401
