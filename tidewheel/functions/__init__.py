"""Column expressions; nothing here touches a DataFrame or a session."""
