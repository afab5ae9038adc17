-- The known customers with the highest revenue. Traffic is summed before it meets them.
WITH totals AS (
    SELECT customer_id, SUM(revenue_eur) AS total_revenue
    FROM traffic
    GROUP BY customer_id
)
SELECT customer_id, total_revenue
FROM totals LEFT SEMI JOIN customers USING (customer_id)
ORDER BY total_revenue DESC, customer_id
LIMIT :top;
