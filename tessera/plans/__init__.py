"""End-to-end pipelines (QP1-QP17) and the registry of named queries over the test tables."""

from tessera.plans import city, payroll, workbook  # noqa: F401
