"""headstart.plans"""
