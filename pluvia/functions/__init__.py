"""Column-level building blocks (all JVM-side built-in expressions)."""

from pluvia.functions.scalars import *  # noqa: F401,F403
from pluvia.functions.scalars import __all__  # noqa: F401
