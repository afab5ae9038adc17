-- Customers per segment and their share of all, in percent.
SELECT
    segment,
    COUNT(*) AS client_count,
    CAST(ROUND(100 * CAST(COUNT(*) AS DECIMAL(18, 0)) / (SELECT COUNT(*) FROM customers), 2) AS DECIMAL(5, 2))
        AS percentage_share
FROM customers
GROUP BY segment
ORDER BY client_count DESC, segment;
