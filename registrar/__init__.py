"""Academic-records analytics as Spark DataFrame operators.

Reports, validated table-scale ingest, derived-state rules and constraint audits
over enrolment, grade, charge and offering tables. Every operator takes and
returns DataFrames and is built from Spark SQL expressions, aggregations, joins
and windows; nothing is collected to the driver.
"""

from registrar.schema import PASS_MARK, GRADE_MIN, GRADE_MAX

__all__ = ["PASS_MARK", "GRADE_MIN", "GRADE_MAX"]
