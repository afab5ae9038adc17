-- The star as catalog tables. A column that an INSERT leaves out gets its default.
CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:schema) LOCATION :path;
CREATE TABLE IF NOT EXISTS IDENTIFIER(:schema || '.customers') (
    customer_id BIGINT NOT NULL,
    account_id BIGINT NOT NULL,
    customer_name STRING NOT NULL,
    segment STRING NOT NULL,
    industry STRING NOT NULL,
    country STRING NOT NULL,
    created_date DATE DEFAULT CURRENT_DATE
) USING parquet;
CREATE TABLE IF NOT EXISTS IDENTIFIER(:schema || '.channels') (
    channel_id BIGINT NOT NULL,
    channel_name STRING NOT NULL,
    channel_type STRING NOT NULL,
    unit_price_eur DECIMAL(10, 4) NOT NULL
) USING parquet;
CREATE TABLE IF NOT EXISTS IDENTIFIER(:schema || '.traffic') (
    traffic_id BIGINT NOT NULL,
    send_date DATE NOT NULL,
    account_id BIGINT NOT NULL,
    customer_id BIGINT NOT NULL,
    channel_id BIGINT NOT NULL,
    interactions_count INT DEFAULT 0,
    revenue_eur DECIMAL(12, 2) DEFAULT 0.00
) USING parquet;
CREATE TABLE IF NOT EXISTS IDENTIFIER(:schema || '.customers_revenue_by_period') (
    customer_id BIGINT NOT NULL,
    revenue_last_month DECIMAL(22, 2) DEFAULT 0.00,
    revenue_last_quarter DECIMAL(22, 2) DEFAULT 0.00,
    revenue_mtd DECIMAL(22, 2) DEFAULT 0.00,
    revenue_ytd DECIMAL(22, 2) DEFAULT 0.00,
    revenue_increase_pct_qoq DECIMAL(18, 2) DEFAULT NULL,
    last_updated TIMESTAMP DEFAULT CURRENT_TIMESTAMP
) USING parquet;
