-- Of the top fraction of all customers by revenue, those with traffic in every whole month
-- of a window. A limit takes no subquery, so its number is set first. Spark gathers the rows
-- of a limit in one task: beyond some millions of them, use questions.always_active_top.
DECLARE OR REPLACE VARIABLE top_rows INT DEFAULT 0;
SET VARIABLE top_rows = (
    SELECT CAST(CEIL(COUNT(*) * CAST(:fraction AS DECIMAL(9, 8))) AS INT)
    FROM customers
);
WITH activity AS (
    SELECT
        customer_id,
        SUM(revenue_eur) AS total_revenue,
        COUNT(DISTINCT TRUNC(send_date, 'MM')) FILTER (
            WHERE send_date >= ADD_MONTHS(TRUNC(CAST(:as_of AS DATE), 'MM'), - :months)
                AND send_date < TRUNC(CAST(:as_of AS DATE), 'MM')
        ) AS active_months
    FROM traffic
    GROUP BY customer_id
),
top AS (
    SELECT customer_id, total_revenue, active_months
    FROM activity LEFT SEMI JOIN customers USING (customer_id)
    ORDER BY total_revenue DESC, customer_id
    LIMIT top_rows
)
SELECT customer_id, total_revenue
FROM top
WHERE active_months = :months
ORDER BY total_revenue DESC, customer_id;
