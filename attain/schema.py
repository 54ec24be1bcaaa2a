"""Column contracts of the raw extracts and the declared constraints of the star schema."""

from __future__ import annotations

from dataclasses import dataclass

# Everything a person may have typed stays text until it has been standardised.
RAW = {
    "sales_lines": """line_id string, document_no string, doc_type string, original_document_no string,
        document_date string, rep_code string, customer_code string, country string, sku string, quantity string,
        unit_list_price_local string, discount_pct string, net_amount_local string, currency string,
        exported_at string""",
    "sales_targets": "target_month string, rep_code string, target_amount_usd decimal(18,2), revision_no int, "
                     "revised_at date",
    "team_plan": "team_id string, plan_month string, planned_headcount int, plan_amount_usd decimal(18,2)",
    "employees": "employee_code string, full_name string, role string, hire_date date, exit_date date, "
                 "home_country string, managed_team_id string",
    "rep_assignments": "rep_code string, team_id string, start_date date, end_date date",
    "teams": "team_id string, team_name string, country_code string, department_code string, hc_2024 int, "
             "hc_2025 int, manager_code string",
    "customers": "customer_code string, customer_name string, country_code string, customer_segment string, "
                 "industry string, city string, owning_team_id string, created_date date",
    "products": "sku string, product_name string, product_line string, list_price_usd decimal(18,2), "
                "unit_cost_pct decimal(6,4)",
    "fx_rates": "fx_month string, currency string, rate_per_usd decimal(10,4)",
    "commission_plans": "plan_id string, plan_name string, effective_from date, effective_to date, tier_order int, "
                        "tier_name string, min_achievement double, max_achievement double, "
                        "commission_rate decimal(5,4), strategic_weight decimal(4,2), "
                        "cap_multiple_of_target decimal(4,2), clawback_window_days int",
}

MODEL = {
    "dim_date": "date_key date year quarter month_num month_name month_key year_month month_start_date day_of_month "
                "days_in_month weekday_name is_month_end_window month_index",
    "dim_team": "team_key team_id team_name department_code department_name country_code country_name manager_code "
                "manager_name hc_2024 hc_2025",
    "dim_employee": "employee_key employee_code full_name role hire_date exit_date employment_status tenure_band "
                    "is_new_hire_in_period current_team_id manager_code country_code department_code",
    "dim_product": "product_key sku product_name product_line list_price_usd unit_cost_pct is_strategic "
                   "commission_weight",
    "dim_customer": "customer_key customer_code customer_name country_code customer_segment industry city "
                    "owning_team_id created_date",
    "bridge": "rep_key month_key team_key tenure_months is_ramp_month",
    "fact_sales": "line_id document_no doc_type original_document_no date_key month_key rep_key team_key customer_key "
                  "product_key country_code currency fx_rate quantity unit_list_price_usd discount_pct "
                  "gross_amount_usd discount_amount_usd net_amount_usd cost_amount_usd gross_margin_usd "
                  "commission_weight days_since_original is_month_end_window net_amount_local",
    "fact_targets": "rep_key team_key month_key date_key target_amount_usd revision_no is_ramp_month",
    "fact_team_plan": "team_key month_key date_key planned_headcount plan_amount_usd",
}


def model_columns(table: str) -> list[str]:
    return MODEL[table].split()


@dataclass(frozen=True)
class Constraint:
    """kind: PK, UNIQUE, NOT NULL, CHECK or FK; for FK the parent is (table, column)."""

    table: str
    kind: str
    columns: tuple[str, ...]
    check: str = ""
    parent: tuple[str, str] = ("", "")

    @property
    def label(self) -> str:
        name = f"{self.table}.{'+'.join(self.columns)} {self.kind}"
        if self.kind == "FK":
            return f"{name} -> {self.parent[0]}.{self.parent[1]}"
        return f"{name} {self.check}".rstrip()


CONSTRAINTS = (
    Constraint("fact_sales", "PK", ("line_id",)),
    Constraint("fact_sales", "NOT NULL", ("document_no",)),
    Constraint("fact_sales", "NOT NULL", ("net_amount_usd",)),
    Constraint("fact_sales", "CHECK", ("doc_type",), "doc_type IN ('INV', 'CN')"),
    Constraint("fact_sales", "FK", ("rep_key",), parent=("dim_employee", "employee_key")),
    Constraint("fact_sales", "FK", ("team_key",), parent=("dim_team", "team_key")),
    Constraint("fact_sales", "FK", ("customer_key",), parent=("dim_customer", "customer_key")),
    Constraint("fact_sales", "FK", ("product_key",), parent=("dim_product", "product_key")),
    Constraint("fact_targets", "PK", ("rep_key", "month_key")),
    Constraint("fact_targets", "CHECK", ("target_amount_usd",), "target_amount_usd > 0"),
    Constraint("fact_targets", "FK", ("rep_key",), parent=("dim_employee", "employee_key")),
    Constraint("fact_team_plan", "PK", ("team_key", "month_key")),
    Constraint("bridge", "PK", ("rep_key", "month_key")),
    Constraint("bridge", "FK", ("team_key",), parent=("dim_team", "team_key")),
    Constraint("bridge", "FK", ("rep_key",), parent=("dim_employee", "employee_key")),
    Constraint("fact_targets", "FK", ("team_key",), parent=("dim_team", "team_key")),
    Constraint("fact_team_plan", "FK", ("team_key",), parent=("dim_team", "team_key")),
    Constraint("fact_sales", "FK", ("country_code",), parent=("dim_country", "country_code")),
    Constraint("dim_country", "PK", ("country_code",)),
    Constraint("dim_team", "PK", ("team_key",)),
    Constraint("dim_team", "UNIQUE", ("team_id",)),
    Constraint("dim_team", "NOT NULL", ("team_name",)),
    Constraint("dim_team", "FK", ("country_code",), parent=("dim_country", "country_code")),
    Constraint("dim_team", "FK", ("department_code",), parent=("dim_department", "department_code")),
    Constraint("dim_employee", "PK", ("employee_key",)),
    Constraint("dim_employee", "UNIQUE", ("employee_code",)),
    Constraint("dim_employee", "NOT NULL", ("hire_date",)),
    Constraint("dim_product", "PK", ("product_key",)),
    Constraint("dim_product", "UNIQUE", ("sku",)),
    Constraint("dim_product", "NOT NULL", ("list_price_usd",)),
    Constraint("dim_customer", "PK", ("customer_key",)),
    Constraint("dim_customer", "UNIQUE", ("customer_code",)),
    Constraint("dim_customer", "FK", ("country_code",), parent=("dim_country", "country_code")),
    Constraint("dim_department", "PK", ("department_code",)),
)
