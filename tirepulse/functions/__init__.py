"""Column-expression helpers shared by all operators (JVM-side, codegen-friendly)."""

from tirepulse.functions.expr import (  # noqa: F401
    any_positive, fill0, ratio, truthy,
)
