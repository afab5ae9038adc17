-- Revenue and customers per industry, with traffic summed per customer first.
WITH revenue AS (
    SELECT customer_id, SUM(revenue_eur) AS revenue
    FROM traffic
    GROUP BY customer_id
)
SELECT
    industry,
    COALESCE(SUM(revenue), 0) AS total_revenue,
    COUNT(customer_id) AS customer_count
FROM customers LEFT JOIN revenue USING (customer_id)
GROUP BY industry
HAVING COUNT(customer_id) >= :min_customers
ORDER BY total_revenue DESC, industry;
