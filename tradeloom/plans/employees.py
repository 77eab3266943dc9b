"""Salary report: grades, ranks and summaries.

    python -m tradeloom.plans.employees --input <csv> --output <folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, functions as F

from tradeloom.functions.columns import tier
from tradeloom.operators.ranking import rank_in_group
from tradeloom.schemas import EMPLOYEES
from tradeloom.session import build_session, written
from tradeloom.sources.files import CORRUPT, read_csv, read_parquet, write_results

# Fixed values of the report.
SALARY_GRADES = [(85_000, "Senior"), (70_000, "Mid")]
LOWEST_GRADE = "Junior"
LETTER_GRADES = [(80_000, "A"), (65_000, "B")]
LOWEST_LETTER = "C"


def with_grade(employees: DataFrame, steps=SALARY_GRADES) -> DataFrame:
    return employees.withColumn("salary_grade", tier("salary", steps, LOWEST_GRADE))


def enrich(employees: DataFrame, steps=SALARY_GRADES) -> DataFrame:
    """Grade, rank within the department by salary, and when the report was made."""
    ranked = rank_in_group(with_grade(employees, steps), ["department"], ["salary desc"], ["emp_id"], "dept_rank")
    return ranked.withColumn("processed_at", F.current_timestamp())


def department_summary(graded: DataFrame) -> DataFrame:
    def graded_as(label: str):
        return F.count(F.when(F.col("salary_grade") == label, 1))

    return (graded.groupBy("department")
            .agg(F.count("emp_id").alias("headcount"),
                 F.round(F.avg("salary"), 2).alias("avg_salary"),
                 F.max("salary").alias("max_salary"),
                 F.min("salary").alias("min_salary"),
                 graded_as("Senior").alias("senior_count"),
                 graded_as("Mid").alias("mid_count"),
                 graded_as("Junior").alias("junior_count"))
            .orderBy(F.desc("avg_salary"), "department"))


def city_summary(employees: DataFrame) -> DataFrame:
    return (employees.groupBy("city")
            .agg(F.count("emp_id").alias("employee_count"),
                 F.round(F.avg("salary"), 2).alias("avg_salary"))
            .orderBy(F.desc("employee_count"), "city"))


def run(employees: DataFrame, output: str) -> None:
    """Write the enriched rows as Parquet, the two summaries as CSV and JSON."""
    # text is parsed once; ranking reads the table twice, the summaries once each
    write_results(enrich(written(employees, "employees")), f"{output}/enriched_employees", "parquet")
    enriched = read_parquet(employees.sparkSession, f"{output}/enriched_employees")
    write_results(department_summary(enriched), f"{output}/dept_summary_csv", "csv")
    write_results(city_summary(enriched), f"{output}/city_summary_json", "json")


def main(argv: list[str] | None = None) -> None:
    arguments = argparse.ArgumentParser(description="Salary report")
    arguments.add_argument("--input", required=True)
    arguments.add_argument("--output", required=True)
    given = arguments.parse_args(argv)
    spark = build_session("salary-report")
    run(read_csv(spark, given.input, EMPLOYEES).drop(CORRUPT), given.output)


if __name__ == "__main__":
    main()
