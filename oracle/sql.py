"""Independent DuckDB SQL for every registered query, over the same parquet tables."""

from __future__ import annotations

RETAIL = """
once AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
         CASE WHEN l_orderkey % 503 = 7 THEN NULL ELSE o_custkey END AS customer_id,
         CASE WHEN o_custkey % 250 = 1 THEN 'Shared Name' ELSE c_name END AS customer_name,
         CASE WHEN l_orderkey % 601 = 3 THEN l_partkey + 10000000 ELSE l_partkey END AS product_id,
         CASE WHEN l_orderkey % 13 = 0 THEN NULL
              WHEN l_orderkey % 101 = 0 THEN p_retailprice + 1
              ELSE p_retailprice END AS price,
         CASE WHEN l_orderkey % 29 = 0 THEN upper(p_name) ELSE p_name END AS product_name,
         CASE WHEN l_orderkey % 59 = 3 THEN 'UNKNOWN' ELSE p_type END AS category,
         CASE WHEN l_orderkey % 3 = 0 THEN 'Online' ELSE 'Offline' END AS purchase_location,
         CASE WHEN l_orderkey % 211 = 0 THEN '  ' ELSE n_name END AS city,
         CASE WHEN l_orderkey % 401 = 1 THEN 'unknown'
              WHEN l_orderkey % 409 = 1 THEN NULL
              WHEN l_orderkey % 5 <= 2 THEN strftime(l_shipdate, '%Y-%m-%d')
              WHEN l_orderkey % 5 = 3 THEN strftime(l_shipdate, '%m-%d-%Y')
              ELSE strftime(l_shipdate, '%d-%m-%Y') END AS transaction_date,
         CAST(CASE WHEN l_orderkey % 307 = 5 THEN NULL
                   WHEN l_orderkey % 97 = 0 THEN -l_quantity ELSE l_quantity END AS INTEGER)
           AS quantity,
         l_returnflag AS payment_method,
         CAST(CAST(round(l_discount * 100) AS INTEGER)
              * CASE WHEN l_orderkey % 89 = 0 THEN -1 ELSE 1 END AS DOUBLE) AS discount,
         CASE WHEN o_custkey % 113 = 5 THEN NULL
              WHEN o_custkey % 127 = 5 THEN ''
              WHEN o_custkey % 41 = 0 THEN 'user' || o_custkey || '.example.com'
              WHEN o_custkey % 300 = 7 THEN 'shared@example.com'
              ELSE 'user' || o_custkey || '@example.com' END AS email,
         CAST(CASE WHEN o_custkey % 131 = 5 THEN NULL
                   WHEN o_custkey % 37 = 0 THEN 600000000 + o_custkey
                   ELSE 6000000000 + o_custkey END AS VARCHAR) AS phone,
         CASE WHEN l_linestatus = 'F' THEN 'FAILED' ELSE 'successful' END AS payment_status,
         CASE WHEN l_orderkey % 2 = 0 THEN 'retail1' ELSE 'retail2' END AS src
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation ON c_nationkey = n_nationkey
),
tagged AS (
  SELECT * FROM once
  UNION ALL SELECT * FROM once WHERE (transaction_id // 10) % 223 = 5
),
retail AS (SELECT * EXCLUDE (src) FROM tagged),
catalog_once AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 103 = 1 THEN '' ELSE p_name END AS product_name,
         p_type AS category,
         CASE WHEN p_partkey % 83 = 2 THEN NULL
              WHEN p_partkey % 89 = 3 THEN 0.0
              WHEN p_partkey % 97 = 4 THEN -p_retailprice
              ELSE p_retailprice END AS price
  FROM part
),
catalog AS (
  SELECT * FROM catalog_once
  UNION ALL SELECT * FROM catalog_once WHERE product_id % 107 = 6
)"""

COLUMNS = [
    "transaction_id",
    "customer_id",
    "customer_name",
    "product_id",
    "price",
    "product_name",
    "category",
    "purchase_location",
    "city",
    "transaction_date",
    "quantity",
    "payment_method",
    "discount",
    "email",
    "phone",
    "payment_status",
]
NUMERIC = ["transaction_id", "customer_id", "product_id", "price", "quantity", "discount"]
TYPES = {
    "transaction_id": "bigint",
    "customer_id": "bigint",
    "product_id": "bigint",
    "price": "double",
    "quantity": "int",
    "discount": "double",
}
DOMAINS = ["payment_method", "payment_status", "city", "purchase_location", "discount", "quantity"]
OTHERS = [c for c in COLUMNS if c != "transaction_id"]
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# Where the raw copy holds a word in place of a number.
SPOILED = {"quantity": "transaction_id % 997 = 1", "price": "transaction_id % 499 = 2"}

# The first rule a row breaks; the other rules are never broken in this view.
REASON = """CASE WHEN customer_id IS NULL THEN 'null:customer_id'
  WHEN quantity IS NULL THEN 'null:quantity'
  WHEN transaction_date IS NULL THEN 'null:transaction_date'
  WHEN trim(city, ' ') = '' THEN 'blank:city' END"""

FACT = r"""
good AS (
  SELECT DISTINCT src, transaction_id, customer_id, product_id, quantity, city,
         transaction_date AS raw_date, purchase_location AS purchase_mode, payment_method,
         discount, payment_status
  FROM tagged
  WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
    AND quantity IS NOT NULL AND discount IS NOT NULL
    AND trim(transaction_date, ' ') <> '' AND trim(city, ' ') <> ''
    AND trim(purchase_location, ' ') <> '' AND trim(payment_method, ' ') <> ''
    AND trim(payment_status, ' ') <> ''
),
fact AS (
  SELECT transaction_id, customer_id, product_id, quantity,
         CASE WHEN quantity >= 0 THEN 'Valid' ELSE 'Invalid' END AS valid_quantity,
         city,
         CASE WHEN try_cast(split_part(raw_date, '-', 1) AS INTEGER) > 31
                THEN CAST(try_strptime(raw_date, '%Y-%m-%d') AS DATE)
              WHEN try_cast(split_part(raw_date, '-', 1) AS INTEGER) > 12
                THEN CAST(try_strptime(raw_date, '%d-%m-%Y') AS DATE)
              ELSE CAST(try_strptime(raw_date, '%m-%d-%Y') AS DATE) END AS transaction_date,
         purchase_mode, payment_method, discount,
         CASE WHEN discount >= 0 THEN 'Valid' ELSE 'Invalid' END AS valid_discount,
         upper(substr(payment_status, 1, 1)) || lower(substr(payment_status, 2)) AS payment_status
  FROM good
)"""

FACT_COLUMNS = """transaction_id, customer_id, product_id, quantity, valid_quantity, city,
  strftime(transaction_date, '%Y-%m-%d') AS transaction_date, purchase_mode, payment_method,
  discount, valid_discount, payment_status"""

CUSTOMERS = rf"""
contacts AS (
  SELECT DISTINCT customer_id, customer_name, email, phone, src
  FROM tagged
  WHERE customer_id IS NOT NULL AND trim(customer_name, ' ') <> '' AND trim(email, ' ') <> ''
    AND regexp_matches(email, '{EMAIL}')
    AND length(regexp_replace(phone, '\D', '', 'g')) = 10
),
customers AS (
  SELECT customer_id, customer_name, sha256(email) AS email_hash, sha256(phone) AS phone_hash
  FROM contacts
)"""

PRICED = """
products AS (
  SELECT DISTINCT product_id, product_name, category, price FROM catalog
  WHERE product_id IS NOT NULL AND product_name IS NOT NULL AND category IS NOT NULL
    AND price IS NOT NULL AND NOT isnan(price)
),
priced AS (
  SELECT f.transaction_id, f.product_id, p.product_name, p.category, f.city,
         f.transaction_date, f.quantity * p.price AS amount
  FROM fact f JOIN products p USING (product_id)
  WHERE valid_quantity = 'Valid' AND valid_discount = 'Valid' AND payment_status = 'Successful'
)"""

CENTS = "sum(CAST(round(amount * 100) AS HUGEINT))"
KPI = f"""CAST({CENTS} AS DOUBLE) / 100 AS revenue,
  count(DISTINCT transaction_id) AS orders,
  (CAST({CENTS} AS DOUBLE) / 100) / count(DISTINCT transaction_id) AS avg_order_value"""

REPEATED = """
repeated AS (
  SELECT transaction_id, count(*) AS cnt FROM retail GROUP BY transaction_id HAVING count(*) > 1
)"""

COMPARED = (
    REPEATED
    + """,
compared AS (
  SELECT transaction_id, count(*) AS row_count, """
    + ", ".join(f"count(DISTINCT {c}) AS {c}_distinct" for c in OTHERS)
    + """
  FROM retail JOIN repeated USING (transaction_id) GROUP BY transaction_id
)"""
)
CONFLICT = " OR ".join(f"{c}_distinct > 1" for c in OTHERS)

SHAPE = r"""
shaped AS (
  SELECT transaction_date,
         CASE WHEN regexp_matches(transaction_date, '^\d{4}-\d{2}-\d{2}$') THEN 'yyyy-MM-dd'
              WHEN regexp_matches(transaction_date, '^\d{2}-\d{2}-\d{4}$')
                THEN 'dd-MM-yyyy or MM-dd-yyyy' END AS date_format
  FROM retail
),
ordered AS (
  SELECT transaction_date, date_format,
         CASE WHEN date_format = 'dd-MM-yyyy or MM-dd-yyyy' THEN
                CASE WHEN CAST(split_part(transaction_date, '-', 1) AS INTEGER) > 12
                       THEN 'dd-MM-yyyy'
                     WHEN CAST(split_part(transaction_date, '-', 2) AS INTEGER) > 12
                       THEN 'MM-dd-yyyy' END
              ELSE date_format END AS date_order
  FROM shaped
)"""

JOINED = """
joined AS (
  SELECT r.*, c.product_name AS master_product_name, c.category AS master_category,
         c.price AS master_price
  FROM retail r JOIN catalog c ON r.product_id = c.product_id
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([RETAIL, *ctes]) + "\n"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _group(column: str, expression: str) -> str:
    return _with() + f"SELECT {expression} AS {column}, count(*) AS row_count FROM retail GROUP BY 1"


def _validity(column: str, condition: str) -> str:
    verdict = f"coalesce({condition}, false)"
    return _with() + _union(
        [
            f"""SELECT true AS {column}, count(*) FILTER (WHERE {verdict}) AS row_count,
            count(*) FILTER (WHERE {verdict}) / count(*) * 100 AS pct FROM retail""",
            f"""SELECT false AS {column}, count(*) FILTER (WHERE NOT {verdict}) AS row_count,
            count(*) FILTER (WHERE NOT {verdict}) / count(*) * 100 AS pct FROM retail""",
        ]
    )


def _summary(label: str, relation: str) -> str:
    return (
        _with()
        + f""", n AS (SELECT (SELECT count(*) FROM {relation}) AS total,
                       (SELECT count(*) FROM (SELECT DISTINCT * FROM {relation})) AS uniq)
SELECT 'Unique' AS {label}, uniq AS row_count, uniq / total * 100 AS pct FROM n
UNION ALL
SELECT 'Duplicate', total - uniq, (total - uniq) / total * 100 FROM n"""
    )


def _orphans(name: str, key: str, dimension: str) -> str:
    return f"""SELECT '{name}' AS dimension, count(*) AS source_rows,
  count(DISTINCT f.{key}) FILTER (WHERE d.{key} IS NULL) AS orphan_keys,
  count(*) FILTER (WHERE d.{key} IS NULL) AS orphan_rows
FROM fact f LEFT JOIN (SELECT DISTINCT {key} FROM {dimension}) d ON f.{key} = d.{key}"""


def _describe(columns: list[str], relation: str) -> str:
    def line(c: str) -> str:
        number = c in NUMERIC
        mean = f"round(avg({c}), 6)" if number else "CAST(NULL AS DOUBLE)"
        dev = f"round(stddev_samp({c}), 6)" if number else "CAST(NULL AS DOUBLE)"
        return f"""SELECT '{c}' AS "column", count({c}) AS "count", {mean} AS mean,
  {dev} AS stddev, CAST(min({c}) AS VARCHAR) AS "min", CAST(max({c}) AS VARCHAR) AS "max"
FROM {relation}"""

    return _with() + _union([line(c) for c in columns])


def _schema(columns: list[str], relation: str) -> str:
    return _with() + _union(
        [
            f"""SELECT '{c}' AS "column", {i} AS "position", '{TYPES.get(c, "string")}' AS "type",
  count(*) AS row_count, count({c}) AS non_null_count FROM {relation}"""
            for i, c in enumerate(columns, start=1)
        ]
    )


def _gate(name: str, expected: str, actual: str, passed: str) -> str:
    return f"""SELECT '{name}' AS "check", CAST({expected} AS BIGINT) AS expected,
  CAST({actual} AS BIGINT) AS actual, {passed} AS passed"""


def _equal(name: str, expected: str, actual: str) -> str:
    return _gate(name, expected, actual, f"({expected}) = ({actual})")


def _filled(name: str, actual: str) -> str:
    return _gate(name, "1", actual, f"({actual}) > 0")


def _rows(relation: str, where: str = "true") -> str:
    return f"(SELECT count(*) FROM {relation} WHERE {where})"


def _tagged_gates(table: str, relation: str, published: str) -> list[str]:
    one, two = _rows(relation, "src = 'retail1'"), _rows(relation, "src = 'retail2'")
    return [
        _filled(f"{table}: rows of retail1", one),
        _filled(f"{table}: rows of retail2", two),
        _equal(f"{table}: union of sources", f"{one} + {two}", _rows(relation)),
        _equal(f"{table}: rows published", _rows(relation), _rows(published)),
    ]


NULLS_REQUIRED = {
    "dim_product": ("catalog", ["product_id", "product_name", "category", "price"]),
    "dim_customer": ("retail", ["customer_id", "customer_name", "email", "phone"]),
    "fact_sales": (
        "retail",
        [
            "transaction_id",
            "customer_id",
            "product_id",
            "quantity",
            "discount",
            "transaction_date",
            "city",
            "purchase_location",
            "payment_method",
            "payment_status",
        ],
    ),
}
BLANKS_REQUIRED = {
    "dim_customer": ("retail", ["customer_id", "customer_name", "email"]),
    "fact_sales": (
        "retail",
        ["city", "purchase_location", "payment_method", "payment_status", "transaction_date"],
    ),
}


def _passing(requirements: dict, test: str) -> str:
    return _with() + _union(
        [
            f"""SELECT '{table}' AS "table", count(*) AS total_rows,
  count(*) FILTER (WHERE {" AND ".join(test.format(c) for c in columns)}) AS passing_rows
FROM {relation}"""
            for table, (relation, columns) in requirements.items()
        ]
    )


def _unpivot(columns: list[str], relation: str) -> str:
    return _with() + _union(
        [
            f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS "value", count(*) AS row_count
FROM {relation} GROUP BY {c}"""
            for c in columns
        ]
    )


def _distinct(columns: list[str], relation: str) -> str:
    return _with() + _union(
        [
            f"""SELECT '{c}' AS "column",
  count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_count
FROM {relation}"""
            for c in columns
        ]
    )


HISTOGRAM = (
    _with()
    + """, b AS (
  SELECT CASE WHEN min(price) = max(price) THEN min(price) - 0.5 ELSE min(price) END AS lo,
         CASE WHEN min(price) = max(price) THEN max(price) + 0.5 ELSE max(price) END AS hi
  FROM catalog WHERE NOT isnan(price)
),
bins AS (
  SELECT CAST(i AS INTEGER) AS bin, lo + (i - 1) * ((hi - lo) / 10) AS lower_edge,
         CASE WHEN i = 10 THEN hi ELSE lo + i * ((hi - lo) / 10) END AS upper_edge
  FROM b, range(1, 11) t(i)
)
SELECT bin, lower_edge, upper_edge,
       (SELECT count(*) FROM catalog
        WHERE price >= lower_edge AND (price < upper_edge OR bin = 10)) AS row_count
FROM bins"""
)


def statements() -> dict[str, str]:
    q: dict[str, str] = {}

    # Sources, sinks, load control
    q["load_gate"] = _with() + _union(
        [
            _gate("retail1: columns", "16", "16", "true"),
            _filled("retail1: rows", _rows("tagged", "src = 'retail1'")),
            _gate("retail2: columns", "16", "16", "true"),
            _filled("retail2: rows", _rows("tagged", "src = 'retail2'")),
            _gate("catalog: columns", "4", "4", "true"),
            _filled("catalog: rows", _rows("catalog")),
        ]
    )
    # An empty field of a delimited file is a missing value.
    q["landing_to_raw"] = _with() + "SELECT * REPLACE (nullif(email, '') AS email) FROM tagged"
    q["landing_to_raw_catalog"] = _with() + (
        "SELECT * REPLACE (nullif(product_name, '') AS product_name) FROM catalog"
    )
    q["contract_violations"] = _with() + _union(
        [
            f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {SPOILED.get(c, "false")}) AS lost
FROM retail"""
            for c in [*NUMERIC, "_corrupt_line"]
        ]
    )
    q["csv_roundtrip"] = _with(FACT) + f"SELECT {FACT_COLUMNS} FROM fact"
    order = "transaction_id, payment_status, product_id, customer_id, price, quantity, discount"
    first = f"{order}, transaction_date".replace(",", " NULLS FIRST,")
    q["preview_top_n"] = _with() + (
        f"SELECT * FROM retail ORDER BY {first} NULLS FIRST LIMIT 10"
    )
    q["schema_report"] = _schema(COLUMNS, "retail")
    q["schema_report_catalog"] = _schema(
        ["product_id", "product_name", "category", "price"], "catalog"
    )

    # Filters and predicates
    q["required_not_null"] = _passing(NULLS_REQUIRED, "{} IS NOT NULL")
    q["required_not_blank"] = _passing(BLANKS_REQUIRED, "trim(CAST({} AS VARCHAR), ' ') <> ''")
    q["email_validation"] = _validity("email_valid", f"regexp_matches(email, '{EMAIL}')")
    q["phone_validation"] = _validity(
        "phone_valid", r"length(regexp_replace(phone, '\D', '', 'g')) = 10"
    )
    q["phone_strict_validation"] = _validity("phone_valid", r"regexp_matches(phone, '^\d{10}$')")
    q["missing_phones"] = _with() + (
        "SELECT count(*) AS rows_read, count(*) FILTER (WHERE phone IS NULL) AS missing FROM retail"
    )
    blank = "(product_name IS NULL OR product_name = '')"
    q["blank_product_name"] = _with() + _union(
        [
            f"SELECT 'blank' AS state, count(*) FILTER (WHERE {blank}) AS row_count FROM catalog",
            f"SELECT 'filled', count(*) FILTER (WHERE NOT {blank}) FROM catalog",
        ]
    )
    q["price_range_check"] = _with() + _union(
        [
            f"""SELECT '{label}' AS "range", count(*) FILTER (WHERE {test}) AS row_count
FROM catalog"""
            for label, test in [
                ("negative", "price < 0"),
                ("zero", "price = 0"),
                ("positive", "price > 0"),
                ("missing", "price IS NULL"),
            ]
        ]
    )
    q["lookup_by_ids"] = _with() + "SELECT * FROM retail WHERE transaction_id IN (202, 277, 1351)"

    # Catalog checks and joins
    q["sales_product_join"] = _with(JOINED) + "SELECT * FROM joined"
    q["price_mismatch"] = _with(JOINED) + (
        "SELECT * FROM joined WHERE price IS NOT NULL AND price <> master_price"
    )
    q["catalog_mismatch"] = (
        _with(JOINED)
        + """SELECT transaction_id, product_id, product_name AS retail_product_name,
  master_product_name,
  CASE WHEN product_name <> master_product_name THEN 'Mismatch' ELSE 'Match' END AS name_check,
  category AS retail_category, master_category,
  CASE WHEN category <> master_category THEN 'Mismatch' ELSE 'Match' END AS category_check
FROM joined WHERE product_name <> master_product_name OR category <> master_category"""
    )
    q["ri_orphans"] = _with(FACT, CUSTOMERS) + _union(
        [_orphans("product", "product_id", "catalog"), _orphans("customer", "customer_id", "customers")]
    )
    q["star_enriched"] = (
        _with(FACT, CUSTOMERS, PRICED)
        + """, one AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
             ORDER BY customer_name, email_hash, phone_hash) AS rn FROM customers)
  WHERE rn = 1
)
SELECT f.* EXCLUDE (transaction_date),
  strftime(f.transaction_date, '%Y-%m-%d') AS transaction_date,
  p.product_name, p.category, p.price, o.customer_name, o.email_hash, o.phone_hash,
  CAST(year(f.transaction_date) * 10000 + month(f.transaction_date) * 100
       + day(f.transaction_date) AS INTEGER) AS date_id,
  CAST(year(f.transaction_date) AS INTEGER) AS "year",
  CAST(month(f.transaction_date) AS INTEGER) AS "month",
  CAST(day(f.transaction_date) AS INTEGER) AS "day"
FROM fact f LEFT JOIN products p USING (product_id) LEFT JOIN one o USING (customer_id)"""
    )

    # Duplicates and shared contacts
    q["dup_keys"] = _with(REPEATED) + "SELECT * FROM repeated"
    q["dup_catalog_keys"] = _with() + (
        """SELECT count(*) AS "keys", count(*) FILTER (WHERE n > 1) AS repeated_keys
FROM (SELECT product_id, count(*) AS n FROM catalog GROUP BY product_id)"""
    )
    q["dup_rows"] = _with(REPEATED) + "SELECT retail.* FROM retail SEMI JOIN repeated USING (transaction_id)"
    q["dup_comparison"] = _with(COMPARED) + "SELECT * FROM compared"
    q["dup_conflicts"] = _with(COMPARED) + f"SELECT * FROM compared WHERE {CONFLICT}"
    q["dup_conflict_rows"] = _with(COMPARED) + (
        "SELECT * FROM retail WHERE transaction_id IN "
        f"(SELECT transaction_id FROM compared WHERE {CONFLICT})"
    )
    q["shared_names"] = _with() + (
        """SELECT DISTINCT customer_id, customer_name FROM retail WHERE customer_name IN (
  SELECT customer_name FROM retail GROUP BY customer_name HAVING count(DISTINCT customer_id) > 1)"""
    )
    q["shared_emails"] = _with() + (
        """SELECT DISTINCT customer_id, customer_name, email, phone FROM retail WHERE email IN (
  SELECT email FROM retail GROUP BY email HAVING count(DISTINCT customer_id) > 1)"""
    )
    q["customer_pairs"] = _with() + "SELECT DISTINCT customer_id, customer_name FROM retail"
    q["full_row_duplicates"] = (
        _with()
        + """SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_rows FROM (
  SELECT (SELECT count(*) FROM retail) AS total_rows,
         (SELECT count(*) FROM (SELECT DISTINCT * FROM retail)) AS distinct_rows)"""
    )
    q["duplicate_summary"] = _summary("type", "retail")
    q["customer_id_dup_summary"] = _summary("status", "(SELECT customer_id FROM retail)")
    q["union_sources"] = _with() + "SELECT * FROM tagged"

    # Profiles
    q["domain_values"] = _unpivot(DOMAINS, "retail")
    q["category_distribution"] = _with() + (
        "SELECT category, count(*) AS row_count FROM catalog GROUP BY category"
    )
    q["null_profile"] = (
        _with()
        + "SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in COLUMNS)
        + " FROM retail"
    )
    q["null_profile_pct"] = _with() + _union(
        [
            f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing_count,
  count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100 AS missing_pct FROM retail"""
            for c in COLUMNS
        ]
    )
    q["distinct_profile"] = _distinct(COLUMNS, "retail")
    q["distinct_profile_catalog"] = _distinct(
        ["product_id", "product_name", "category", "price"], "catalog"
    )
    q["describe_numeric"] = _describe(COLUMNS, "retail")
    q["describe_catalog"] = _describe(
        ["product_id", "product_name", "category", "price"], "catalog"
    )
    q["price_summary"] = (
        _with()
        + """SELECT count(price) AS "count", round(avg(price), 6) AS mean,
  round(stddev_samp(price), 6) AS stddev, min(price) AS "min",
  quantile_disc(price, 0.25) AS p25, quantile_disc(price, 0.5) AS p50,
  quantile_disc(price, 0.75) AS p75, max(price) AS "max" FROM catalog"""
    )
    q["price_histogram"] = HISTOGRAM
    q["quantity_flag"] = _group(
        "valid_quantity", "CASE WHEN quantity >= 0 THEN 'Valid' ELSE 'Invalid' END"
    )
    q["quantity_flag_profile"] = _group(
        "valid_quantity", "CASE WHEN quantity < 0 THEN 'INVALID' ELSE 'VALID' END"
    )
    q["quantity_flag_values"] = (
        _with()
        + """SELECT quantity, CASE WHEN quantity < 0 THEN 'INVALID' ELSE 'VALID' END
  AS valid_quantity, count(*) AS row_count FROM retail GROUP BY ALL"""
    )
    q["discount_flag"] = _group(
        "valid_discount", "CASE WHEN discount >= 0 THEN 'Valid' ELSE 'Invalid' END"
    )
    q["phone_length_profile"] = _group("phone_length", "CAST(length(phone) AS INTEGER)")
    for name, column in [("date_format_profile", "date_format"), ("date_order_profile", "date_order")]:
        q[name] = _with(SHAPE) + f"SELECT {column}, count(*) AS row_count FROM ordered GROUP BY 1"
    q["date_order_chart_data"] = _with(SHAPE) + (
        "SELECT date_order, count(*) AS row_count FROM ordered "
        "WHERE date_order IS NOT NULL GROUP BY 1"
    )
    q["date_format_values"] = _with(SHAPE) + (
        "SELECT transaction_date, date_format, date_order, count(*) AS row_count "
        "FROM ordered GROUP BY ALL"
    )
    q["date_standardise"] = (
        _with()
        + """SELECT transaction_date,
  strftime(CASE WHEN try_cast(split_part(transaction_date, '-', 1) AS INTEGER) > 31
                  THEN try_strptime(transaction_date, '%Y-%m-%d')
                WHEN try_cast(split_part(transaction_date, '-', 1) AS INTEGER) > 12
                  THEN try_strptime(transaction_date, '%d-%m-%Y')
                ELSE try_strptime(transaction_date, '%m-%d-%Y') END, '%Y-%m-%d') AS standard_date,
  count(*) AS row_count FROM retail GROUP BY ALL"""
    )

    # Privacy
    masked = """substr(email, 1, 2) || '******' || regexp_extract(email, '(@.*)', 1)
  AS email_masked, {}substr(phone, 1, 2) || '******' || substr(phone, 9, 2) AS phone_masked"""
    q["mask_pii"] = (
        _with()
        + "SELECT customer_id, customer_name, email, "
        + masked.format("phone, ")
        + " FROM retail"
    )

    # Published tables
    q["dim_product"] = _with(FACT, PRICED) + "SELECT * FROM products"
    q["dim_customer"] = _with(CUSTOMERS) + "SELECT * FROM customers"
    q["dim_customer_deduped"] = _with(CUSTOMERS) + (
        "SELECT customer_id, customer_name, sha256(email) AS email_hash, "
        "sha256(phone) AS phone_hash "
        "FROM (SELECT DISTINCT customer_id, customer_name, email, phone FROM contacts)"
    )
    q["fact_sales"] = _with(FACT) + f"SELECT {FACT_COLUMNS} FROM fact"
    q["status_split"] = _with(FACT) + (
        f"""SELECT {FACT_COLUMNS}, CASE WHEN payment_status IN ('Successful', 'Failed')
  THEN lower(payment_status) ELSE 'other' END || '_sales' AS split FROM fact"""
    )
    q["run_audit"] = _with() + (
        """SELECT 'retail_star' AS pipeline_name, CASE WHEN count(*) FILTER (WHERE src = 'retail1') > 0
  AND count(*) FILTER (WHERE src = 'retail2') > 0 AND (SELECT count(*) FROM catalog) > 0
  THEN 'Succeeded' ELSE 'Failed' END AS status, 'load-gate' AS run_id FROM tagged"""
    )
    q["rejected_sales"] = (
        _with()
        + f"SELECT * FROM (SELECT tagged.*, {REASON} AS reject_reason FROM tagged) "
        + "WHERE reject_reason IS NOT NULL"
    )
    kept = f"({REASON}) IS NULL"
    day, month = (f"try_cast(split_part(transaction_date, '-', {i}) AS INTEGER)" for i in (1, 2))
    either = f"regexp_matches(transaction_date, '^[0-9][0-9]-') AND {day} <= 12 AND {month} <= 12"
    q["run_findings"] = _with() + _union(
        [
            f"SELECT '{name}' AS finding, count(*) FILTER (WHERE {test}) AS row_count FROM tagged"
            for name, test in [
                ("rejected_rows", f"NOT ({kept})"),
                ("unreadable_dates", f"{kept} AND transaction_date = 'unknown'"),
                ("ambiguous_dates", f"{kept} AND {either}"),
            ]
        ]
    )
    q["dim_date"] = (
        _with(FACT)
        + """, d AS (
  SELECT unnest(generate_series(min(transaction_date)::TIMESTAMP, max(transaction_date)::TIMESTAMP,
                                INTERVAL 1 DAY)) AS day FROM fact
)
SELECT strftime(day, '%Y-%m-%d') AS "date", CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_id,
  CAST(year(day) AS INTEGER) AS "year", CAST(month(day) AS INTEGER) AS "month",
  CAST(day(day) AS INTEGER) AS "day" FROM d"""
    )
    q["reconcile_counts"] = _with(FACT, CUSTOMERS, PRICED) + _union(
        [
            _filled("products: rows", _rows("products")),
            _equal("products: rows kept", _rows("catalog"), _rows("products")),
            *_tagged_gates("customers", "contacts", "customers"),
            *_tagged_gates("sales", "good", "fact"),
            _equal(
                "sales: accepted and rejected",
                _rows("tagged"),
                _rows("tagged", f"({REASON}) IS NULL")
                + " + "
                + _rows("tagged", f"({REASON}) IS NOT NULL"),
            ),
        ]
    )

    # Indicators
    priced = _with(FACT, PRICED)
    q["kpi_summary"] = priced + f"SELECT {KPI} FROM priced"
    q["kpi_by_category"] = priced + f"SELECT category, {KPI} FROM priced GROUP BY 1"
    q["kpi_by_city"] = priced + f"SELECT city, {KPI} FROM priced GROUP BY 1"
    q["kpi_by_product"] = (
        priced + f"SELECT product_id, product_name, {KPI} FROM priced GROUP BY 1, 2"
    )
    q["kpi_by_month"] = priced + (
        f"""SELECT CAST(year(transaction_date) AS INTEGER) AS "year",
  CAST(month(transaction_date) AS INTEGER) AS "month", {KPI} FROM priced GROUP BY 1, 2"""
    )
    return q
