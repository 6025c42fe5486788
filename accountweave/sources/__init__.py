"""Reading and writing tables, landing CRM objects, describe documents."""
