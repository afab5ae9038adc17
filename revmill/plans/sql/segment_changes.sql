-- Customers with two or more segments and traffic since the cutoff. The dimension is asked
-- first: where its key allows one segment each, nothing is left to look for in the traffic.
WITH changed AS (
    SELECT customer_id
    FROM customers
    GROUP BY customer_id
    HAVING COUNT(DISTINCT segment) >= 2
)
SELECT customer_id
FROM changed LEFT SEMI JOIN (
    SELECT customer_id
    FROM traffic
    WHERE send_date >= ADD_MONTHS(CAST(:as_of AS DATE), - :months)
) USING (customer_id)
ORDER BY customer_id;
