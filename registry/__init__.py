"""Every operator bound to the driver's tables, with its SQL counterpart."""
