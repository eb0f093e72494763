"""DataFrame to DataFrame operators: shaping, audit, cleaning, integrity checks and KPIs."""
